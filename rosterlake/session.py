"""Session construction and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster session should carry too (see README, "Running on a cluster").
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str = "rosterlake", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the engine's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the shared folder that ``spark.checkpoint.dir`` names.

    The setting is required: a folder of one machine's own would be written by one
    executor and missed by the others.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError(
            "spark.checkpoint.dir is not set: name a folder that driver and executors share"
        )
    return f"{base.rstrip('/')}/rosterlake/{purpose}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it takes it: whatever store Spark reads and writes."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A scratch folder for staged copies whose last reader ends inside the block, which removes it."""
    folder = scratch_dir(spark, purpose)
    try:
        yield folder
    finally:
        files, place = file_system(spark, folder)
        files.delete(place, True)


def staged(spark: SparkSession, rows: DataFrame, purpose: str, folder: str | None = None) -> DataFrame:
    """``rows`` written once to shared scratch and read back.

    For results several jobs are about to read: they share one computation, and a
    lost executor costs its own tasks rather than the whole lineage. The copy lies in
    ``folder`` (of a ``scratch`` block); without one it goes when the driver ends, since
    whoever gets the rows may read them at any time until then.
    """
    path = f"{folder}/{purpose}-{uuid.uuid4().hex}" if folder else scratch_dir(spark, purpose)
    rows.write.parquet(path)
    if not folder:
        files, place = file_system(spark, path)
        files.deleteOnExit(place)
    return spark.read.schema(rows.schema).parquet(path)
