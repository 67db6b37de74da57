"""Silver rows to the Gold tables.

The two builders over Silver stand alone: either table can be rebuilt, or fail, without the other. Correlations follow from the stored
facility summaries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.config import (
    CORRELATED_MEASURES,
    CORRELATED_QUALITIES,
    CORRELATION_KEY,
    DAILY_METRIC_COLUMNS,
    DAY_KEY,
    DEFAULTS,
    FACILITY_GROUP,
    FACILITY_KEY,
    Settings,
    TablePaths,
)
from rosterlake.functions.calendar import is_weekend
from rosterlake.functions.numeric import exact_mean, exact_sum
from rosterlake.functions.staffing import daily_ratio_columns, meets_minimums
from rosterlake.operators.ranks import rank_correlations
from rosterlake.sinks.tables import insert_only, upsert
from rosterlake.sources.tables import read_quarter

# output column -> daily column it averages, at four decimals
FACILITY_MEANS = {
    "avg_bed_occupancy_rate": "bed_occupancy_rate",
    "avg_CNA_hrs_per_patient": "CNA_hrs_per_patient",
    "avg_RN_hrs_per_patient": "RN_hrs_per_patient",
    "avg_LPN_hrs_per_patient": "LPN_hrs_per_patient",
    "avg_total_hrs_per_patient": "total_hrs_per_patient",
    "avg_contracted_rn_ratio": "contracted_rn_ratio",
}
# output column -> hour column it totals, at one decimal
FACILITY_TOTALS = {
    "total_RN_hours": "Hrs_RN",
    "total_LPN_hours": "Hrs_LPN",
    "total_CNA_hours": "Hrs_CNA",
    "total_contracted_RN_hours": "Hrs_RN_ctr",
    "total_employed_RN_hours": "Hrs_RN_emp",
}


def daily_metrics(silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rounded ratios, compliance and weekday of every Silver row. Narrow: no shuffle.

    The Silver tier stays: it was set from the unrounded ratio, compliance here is
    judged on the rounded ones.
    """
    return (
        silver.withColumns(daily_ratio_columns())
        .withColumns({
            "meets_cms_minimums": meets_minimums(settings),
            "day_of_week": F.dayofweek("WorkDate"),
            "is_weekend": is_weekend(F.col("WorkDate")),
        })
    )


def staffing_metrics(silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Gold daily table."""
    return daily_metrics(silver, settings).select(*DAILY_METRIC_COLUMNS)


def facility_summary(silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Gold quarterly table: one row per facility (and its attributes) and quarter.

    One shuffle; every aggregate has a map-side partial, so a facility sends one row
    per map task whatever its number of days.
    """
    weekend = F.col("is_weekend")
    total = F.col("total_hrs_per_patient")
    grouped = daily_metrics(silver, settings).groupBy(*FACILITY_GROUP).agg(
        exact_mean("MDScensus", 1).alias("avg_daily_census"),
        *[exact_mean(source, 4).alias(name) for name, source in FACILITY_MEANS.items()],
        *[exact_sum(source, 1).alias(name) for name, source in FACILITY_TOTALS.items()],
        F.sum(F.col("meets_cms_minimums").cast("int")).alias("days_meeting_cms_minimum"),
        F.count("WorkDate").alias("total_days_in_quarter"),
        exact_mean(F.when(weekend, total), 4).alias("avg_weekend_hrs_per_patient"),
        exact_mean(F.when(~weekend, total), 4).alias("avg_weekday_hrs_per_patient"),
    )
    share = F.try_divide("days_meeting_cms_minimum", "total_days_in_quarter")
    gap = F.col("avg_weekend_hrs_per_patient") - F.col("avg_weekday_hrs_per_patient")
    return grouped.withColumns({
        "pct_days_meeting_cms": F.round(share * 100, 1),
        "weekend_staffing_gap": F.round(gap, 4),
    }).withColumn(
        "chronically_understaffed", F.col("pct_days_meeting_cms") < settings.chronic_cutoff
    )


def quality_correlations(facilities: DataFrame) -> DataFrame:
    """Gold correlation table: for each quarter, how the ranks of facilities by a staffing measure go with those by a quality."""
    return rank_correlations(facilities, ("quarter",), CORRELATED_MEASURES, CORRELATED_QUALITIES)


def run_facility_summary(
    spark: SparkSession, paths: TablePaths, quarter: str, settings: Settings = DEFAULTS
) -> None:
    """Recompute one quarter's summaries and put them in place of the old ones."""
    silver = read_quarter(spark, paths.silver, quarter)
    # Partitioned by quarter alone, a part of the merge key: see sinks.tables.upsert.
    upsert(spark, facility_summary(silver, settings), paths.facility_summary, FACILITY_KEY, "quarter")


def run_staffing_metrics(
    spark: SparkSession, paths: TablePaths, quarter: str, settings: Settings = DEFAULTS
) -> None:
    """Add one quarter's new days to the daily table."""
    silver = read_quarter(spark, paths.silver, quarter)
    insert_only(
        spark, staffing_metrics(silver, settings), paths.staffing_metrics,
        DAY_KEY, ("quarter", "STATE"), range_column="WorkDate",
    )


def run_quality_correlations(spark: SparkSession, paths: TablePaths, quarter: str) -> None:
    """Recompute one quarter's correlations from its stored facility summaries."""
    facilities = read_quarter(spark, paths.facility_summary, quarter)
    upsert(spark, quality_correlations(facilities), paths.quality_correlations, CORRELATION_KEY, "quarter")


def run_gold(
    spark: SparkSession, paths: TablePaths, quarter: str, settings: Settings = DEFAULTS
) -> None:
    """All tables in one call."""
    run_facility_summary(spark, paths, quarter, settings)
    run_staffing_metrics(spark, paths, quarter, settings)
    run_quality_correlations(spark, paths, quarter)
