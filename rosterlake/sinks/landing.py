"""Offered files into the landing area, byte for byte."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.session import staged
from rosterlake.sources.stores import open_store
from rosterlake.sources.tables import landing_path

_LANDED = "quarter string, name string, length long, sha256 string"
_BLOCK = 8 << 20
#: Copies that one task makes, one after the other; at most so many tasks.
_FILES_PER_TASK, _MOST_TASKS = 16, 10_000


def _copy(source: str, target: str) -> tuple[int, str]:
    """Copy one file in blocks to a temporary name beside its target, then rename; returns length and digest."""
    from_files, from_path = open_store(source)
    to_files, to_path = open_store(target)
    folder, _, name = to_path.rpartition("/")
    to_files.create_dir(folder, recursive=True)
    part = f"{folder}/_{name}.{uuid.uuid4().hex}"  # readers pass over such names
    digest, length = hashlib.sha256(), 0
    with from_files.open_input_stream(from_path) as given, to_files.open_output_stream(part) as out:
        while block := given.read(_BLOCK):
            digest.update(block)
            length += len(block)
            out.write(block)
    to_files.move(part, to_path)
    return length, digest.hexdigest()


def land_files(spark: SparkSession, assigned: DataFrame, bronze: str) -> DataFrame:
    """Copy each file of ``assigned`` (``id``: its location, ``name``, ``quarter``) to its quarter's folder; returns what has landed:
    quarter, name, length and sha256.

    Tasks copy; nothing but the list of files passes through Spark. A repeated task, or a second run, puts the same bytes in
    the same place, and no reader sees half a file. Several files for one place are an error of the caller's list: the last copy stays.
    """
    files = assigned.select("id", "name", "quarter").dropna()
    n = files.count()

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                length, digest = _copy(row["id"], landing_path(bronze, row["quarter"], row["name"]))
                yield pa.RecordBatch.from_pylist([{"quarter": row["quarter"], "name": row["name"], "length": length, "sha256": digest}])

    tasks = max(1, min(_MOST_TASKS, -(-n // _FILES_PER_TASK)))
    spread = files.repartition(tasks, F.xxhash64("id", "quarter"))
    return staged(spark, spread.mapInArrow(copy, _LANDED), "landed")
