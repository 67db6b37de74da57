"""Which quarters are new, and which files belong to them.

A manifest is any DataFrame with a ``name`` column (one row per file offered).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.config import STAFFING_FILE_MARK
from rosterlake.functions.calendar import quarter_from_name


def offered_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files below a drop folder. Only listed: contents are not a selected column."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("name"),
            F.col("path").alias("id"),
            F.col("modificationTime").alias("modifiedTime"),
        )
    )


def landed_quarters(spark: SparkSession, bronze: str) -> DataFrame:
    """The ``quarter=<q>`` folders of the landing area that hold files; none before the first landing."""
    try:
        files = spark.read.format("binaryFile").load(bronze)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = None
    if files is None or "quarter" not in files.columns:
        return spark.createDataFrame([], "quarter string")
    return files.select(F.col("quarter").cast("string").alias("quarter")).distinct()


def with_quarter(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("quarter", quarter_from_name(F.col("name")))


def new_quarters(manifest: DataFrame, existing: DataFrame) -> DataFrame:
    """Quarters named by a staffing file and not yet landed.

    ``existing`` has a ``quarter`` column, of any length. Both sides are made distinct
    before the anti join, so only one row per quarter is compared.
    """
    offered = (
        with_quarter(manifest.filter(F.col("name").contains(STAFFING_FILE_MARK)))
        .filter(F.col("quarter").isNotNull())
        .select("quarter")
        .distinct()
    )
    return offered.join(existing.select("quarter").distinct(), "quarter", "left_anti")


def assign_files(manifest: DataFrame, quarters: DataFrame) -> DataFrame:
    """One row per (file, quarter it must land in).

    A dated file goes to its own quarter if that one is new; an undated file
    goes to every new quarter. The list of new quarters is one small array (a
    label has five digits, so it cannot outgrow 100,000 entries), computed once
    as a scalar subquery: no join and no product of two tables is planned.
    """
    fresh = quarters.agg(F.sort_array(F.collect_set("quarter")).alias("all")).scalar()
    labelled = with_quarter(manifest)
    targets = F.when(F.col("quarter").isNull(), fresh).otherwise(
        F.when(F.array_contains(fresh, F.col("quarter")), F.array("quarter"))
    )
    return labelled.withColumn("quarter", F.explode(targets))
