"""Scans of the layered tables and the landing folder convention."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.config import TablePaths
from rosterlake.session import file_system


#: Partition column that the insert-only writer derives from a table's date: text, part of no key, and
#: not part of what readers get.
DAY_QUARTER = "work_quarter"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", derived: bool = False) -> DataFrame:
    """The table as written; ``derived`` keeps the writer's own partition column."""
    table = spark.read.format(fmt).load(path)
    return table if derived else table.drop(DAY_QUARTER)


def read_if_exists(
    spark: SparkSession, path: str, fmt: str = "parquet", derived: bool = False
) -> DataFrame | None:
    """The table, or None when nothing has been written there yet."""
    files, place = file_system(spark, path)
    if not files.exists(place):
        return None
    try:
        return read_table(spark, path, fmt, derived)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_MISSING_DELTA_TABLE"):
            return None
        raise


def in_quarter(table: DataFrame, quarter: str) -> DataFrame:
    """One quarter. ``quarter`` is a partition column of Silver, so this prunes files."""
    return table.filter(F.col("quarter") == quarter)


def read_quarter(spark: SparkSession, path: str, quarter: str, fmt: str = "parquet") -> DataFrame:
    return in_quarter(read_table(spark, path, fmt), quarter)


def gold_tables(
    spark: SparkSession, paths: TablePaths, fmt: str = "parquet", keep: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The facility and the daily table, as of now.

    ``keep`` marks the facility table for caching: one row per facility and quarter, read
    by every served query. The daily table is left to column and partition pruning.
    """
    facilities = read_table(spark, paths.facility_summary, fmt)
    daily = read_table(spark, paths.staffing_metrics, fmt)
    return (facilities.cache() if keep else facilities), daily


def landing_path(bronze: str, quarter: str, file_name: str = "") -> str:
    """``<bronze>/quarter=<q>/<file>``: one folder per quarter, files byte for byte."""
    return f"{bronze.rstrip('/')}/quarter={quarter}/{file_name}"
