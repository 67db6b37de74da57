"""Reading a written table back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.functions.numeric import row_count
from rosterlake.operators.profile import tier_by_quarter
from rosterlake.plans.serving import daily_compliance_rate, facility_compliance_rate
from rosterlake.sources.tables import read_table


def table_size(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    table = read_table(spark, path, fmt)
    return table.agg(row_count().alias("rows")).withColumn("columns", F.lit(len(table.columns)))


def validate_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Days per quarter and tier as stored."""
    return tier_by_quarter(read_table(spark, path, fmt))


def validate_facility_summary(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return facility_compliance_rate(read_table(spark, path, fmt))


def validate_staffing_metrics(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return daily_compliance_rate(read_table(spark, path, fmt))
