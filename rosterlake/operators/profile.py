"""Data-quality reports over staffing rows.

Reports over many columns read the table once. Those that only count filled rows are one aggregation whose single row is
turned into one row per column; those with sums and means turn values into (column, value) rows first and group by
column, so that the aggregate has a few accumulators instead of some for every column, and stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.config import (
    DAY_KEY,
    DEFAULTS,
    EXPECTED_AFTER_JOIN,
    HOUR_COLUMNS,
    NURSE_TYPE_LABELS,
    STATS_COLUMNS,
    TIER_MEETS,
    TIERS_SHORT_STAFFED,
    Settings,
)
from rosterlake.functions.numeric import (
    exact_mean,
    full_mean,
    percent,
    quotient_mean,
    row_count,
)
from rosterlake.functions.staffing import hours_per_patient, profiling_tier
from rosterlake.operators.clean import enough_census
from rosterlake.operators.quantiles import exact_quantiles


def _per_column(table: DataFrame, measures: dict[str, list[Column]]) -> DataFrame:
    """Aggregate ``measures[column]`` (aliased the same way for every column) in one
    pass and return one row per column."""
    names = {}
    flat = []
    for i, (label, exprs) in enumerate(measures.items()):
        packed = F.struct(*exprs)
        names[label] = f"m{i}"
        flat.append(packed.alias(f"m{i}"))
    one_row = table.agg(*flat)
    rows = F.array(*[
        F.struct(F.lit(label).alias("column_name"), F.col(slot).alias("m"))
        for label, slot in names.items()
    ])
    return one_row.select(F.inline(rows)).select("column_name", "m.*")


def _by_column(table: DataFrame, columns: dict[str, str] | tuple[str, ...], measures: list[Column]) -> DataFrame:
    """Aggregate the numbers of some columns (label to column, or names) as (column_name, value) rows: one row per
    column, also over an empty table."""
    labels = columns if isinstance(columns, dict) else dict(zip(columns, columns))
    wide = table.select(*(F.col(f"`{name}`").cast("double").alias(f"c{i}") for i, name in enumerate(labels.values())))
    long = wide.unpivot([], [f"c{i}" for i in range(len(labels))], "slot", "value")
    found = long.groupBy("slot").agg(*measures)
    every = table.sparkSession.range(1).select(F.explode(F.create_map(*(
        F.lit(x) for i, label in enumerate(labels) for x in (f"c{i}", label)
    ))).alias("slot", "column_name"))
    return every.join(F.broadcast(found), "slot", "left").drop("slot")


# --- shape -------------------------------------------------------------------

def schema_report(table: DataFrame) -> DataFrame:
    """Name, type and filled rows of every column, in table order."""
    report = _per_column(table, {
        field.name: [
            F.lit(i).alias("position"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.count(F.col(f"`{field.name}`")).alias("filled_rows"),
        ]
        for i, field in enumerate(table.schema.fields)
    })
    return report.select("position", "column_name", "data_type", "filled_rows").orderBy("position")


def column_presence(table: DataFrame, expected: tuple[str, ...] = EXPECTED_AFTER_JOIN) -> DataFrame:
    """Which wanted columns a table has; filled rows for those it does."""
    return _per_column(table, {
        name: [
            F.lit("OK" if name in table.columns else "MISSING").alias("status"),
            (F.count(F.col(f"`{name}`")) if name in table.columns else F.lit(None).cast("long"))
            .alias("filled_rows"),
        ]
        for name in expected
    })


def first_rows(table: DataFrame, n: int, order_by: tuple[str, ...] | None = DAY_KEY) -> DataFrame:
    """The first ``n`` rows in key order: a sample every run agrees on.

    With ``order_by=None`` any ``n`` rows: reads only as many files as it takes.
    """
    return (table.orderBy(*order_by) if order_by else table).limit(n)


def joined_preview(
    joined: DataFrame, n: int = 3, columns: tuple[str, ...] = EXPECTED_AFTER_JOIN
) -> DataFrame:
    """A few joined rows, with those of the wanted columns that exist."""
    shown = [F.col(f"`{name}`") for name in columns if name in joined.columns]
    return first_rows(joined, n).select(*shown)


# --- identity ------------------------------------------------------------------

def identity_profile(staffing: DataFrame) -> DataFrame:
    """Facilities, states, quarters and the date range.

    Days are folded away before anything distinct is counted.
    """
    folded = staffing.groupBy("PROVNUM", "STATE", "CY_Qtr").agg(
        F.min("WorkDate").alias("first_day"), F.max("WorkDate").alias("last_day")
    )
    return folded.agg(
        F.count_distinct("PROVNUM").alias("facilities"),
        F.count_distinct("STATE").alias("states"),
        F.count_distinct("CY_Qtr").alias("quarters"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    )


def value_list(table: DataFrame, column: str) -> DataFrame:
    """The sorted distinct values of a column, one per row."""
    return table.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def duplicate_keys(staffing: DataFrame, keys: tuple[str, ...] = DAY_KEY) -> DataFrame:
    """Keys that occur more than once. Keys with a NULL part are not compared."""
    return (
        staffing.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(row_count().alias("rows"))
        .filter("rows > 1")
    )


# --- values ----------------------------------------------------------------------

def nan_as_null(table: DataFrame) -> DataFrame:
    """Profiles count a NaN as missing, in every number alike."""
    floats = [name for name, kind in table.dtypes if kind in ("double", "float")]
    return table.withColumns({n: F.when(~F.isnan(F.col(f"`{n}`")), F.col(f"`{n}`")) for n in floats})


def missing_report(table: DataFrame) -> DataFrame:
    """Columns with NULLs (or NaN): how many, and what share of all rows."""
    table = nan_as_null(table)
    absent = {f"c{i}": F.col(f"`{name}`").isNull().cast("int") for i, name in enumerate(table.columns)}
    long = table.select(*(flag.alias(slot) for slot, flag in absent.items())).unpivot([], list(absent), "slot", "absent")
    name_of = F.create_map(*(F.lit(x) for slot, name in zip(absent, table.columns) for x in (slot, name)))
    report = long.groupBy("slot").agg(F.sum("absent").alias("missing_count"), row_count().alias("rows")).select(
        name_of[F.col("slot")].alias("column_name"),
        "missing_count",
        F.bround(percent(F.col("missing_count"), F.col("rows")), 2).alias("missing_pct"),
    )
    return report.filter("missing_count > 0").orderBy(F.desc("missing_count"), "column_name")


def zero_report(table: DataFrame, columns: tuple[str, ...] = HOUR_COLUMNS) -> DataFrame:
    """Zeros per hour column, and the mean of what is above zero."""
    value = F.col("value")
    zeros, rows = F.count_if(value == 0), row_count()
    report = _by_column(nan_as_null(table), columns, [
        zeros.alias("zero_count"),
        F.bround(percent(zeros, rows), 1).alias("zero_pct"),
        F.when(zeros == rows, F.lit(0.0)).otherwise(exact_mean(F.when(value > 0, value), 2, half_even=True)).alias("mean_nonzero"),
    ])
    counted = report.withColumns({
        "zero_count": F.coalesce("zero_count", F.lit(0).cast("long")),
        # over no rows at all, none is above zero
        "mean_nonzero": F.when(F.col("zero_count").isNull(), 0.0).otherwise(F.col("mean_nonzero")),
    })
    return counted.orderBy(F.desc("zero_pct"), "column_name")


def describe_stats(
    table: DataFrame, columns: tuple[str, ...] = STATS_COLUMNS, digits: int = 2
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column."""
    table = nan_as_null(table)
    stats = _by_column(table, columns, [
        F.count("value").alias("count"),
        exact_mean("value", digits, half_even=True).alias("mean"),
        F.round(F.stddev_samp("value"), digits).alias("std"),
        F.bround(F.min("value"), digits).alias("min"),
        F.bround(F.max("value"), digits).alias("max"),
    ])
    quartiles = exact_quantiles(table, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return stats.join(quartiles, "column_name", "left").select(
        "column_name", F.coalesce("count", F.lit(0).cast("long")).alias("count"), "mean", "std", "min",
        *[F.bround(p, digits).alias(p) for p in ("p25", "p50", "p75")],
        "max",
    )


def outlier_check(
    table: DataFrame, columns: tuple[str, ...] = STATS_COLUMNS[1:], settings: Settings = DEFAULTS
) -> DataFrame:
    """Largest value and rows above the plausible daily hours, per column."""
    report = _by_column(nan_as_null(table), columns, [
        F.max("value").alias("max_value"), F.count_if(F.col("value") > settings.outlier_hours).alias("rows_over"),
    ])
    return report.withColumn("rows_over", F.coalesce("rows_over", F.lit(0).cast("long")))


def hours_by_type(table: DataFrame, labels: dict[str, str] = NURSE_TYPE_LABELS) -> DataFrame:
    """Mean daily hours of each nurse type."""
    return _by_column(table, labels, [full_mean("value").alias("avg_hours")]).withColumnRenamed("column_name", "nurse_type")


def facilities_per_state(staffing: DataFrame, n: int | None = 20) -> DataFrame:
    """Facilities of each state, most first.

    Spark plans the distinct count as (STATE, PROVNUM) groups before STATE groups,
    so a state holding most rows is still spread over tasks.
    """
    ranked = (
        staffing.filter(F.col("STATE").isNotNull())
        .groupBy("STATE")
        .agg(F.count_distinct("PROVNUM").alias("facilities"))
        .orderBy(F.desc("facilities"), "STATE")
    )
    return ranked if n is None else ranked.limit(n)


def census_histogram(staffing: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Equal-width bins of the clipped census, the last one closed, empty ones included.

    Rows are folded to (census, count) first; a clipped census has few values, so
    range and bins are then worked out on a few hundred rows.
    """
    bins = settings.histogram_bins
    counts = (
        staffing.filter(F.col("MDScensus").isNotNull())
        .groupBy(F.least("MDScensus", F.lit(settings.census_clip)).cast("long").alias("census"))
        .agg(row_count().alias("n"))
    )
    span = counts.agg(F.struct(F.min("census").alias("lo"), F.max("census").alias("hi"))).scalar()
    lo, width = span.getField("lo"), span.getField("hi") - span.getField("lo")
    place = F.when(width == 0, F.lit(bins // 2).cast("long")).otherwise(
        F.least(
            F.call_function("div", (F.col("census") - lo) * bins, F.nullif(width, F.lit(0))),
            F.lit(bins - 1).cast("long"),
        )
    )
    filled = counts.groupBy(place.alias("bin")).agg(F.sum("n").alias("days"))
    # A single value gets a bin range one wide around it.
    start = F.when(width == 0, lo - F.lit(0.5)).otherwise(lo.cast("double"))
    step = F.when(width == 0, F.lit(1.0)).otherwise(width.cast("double")) / bins
    every_bin = staffing.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return every_bin.join(filled, "bin", "left").select(
        "bin",
        (start + step * F.col("bin")).alias("bin_from"),
        (start + step * (F.col("bin") + 1)).alias("bin_to"),
        F.coalesce("days", F.lit(0).cast("long")).alias("days"),
    )


# --- tiers and facilities ----------------------------------------------------------

def tier_profile(staffing: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Days per tier over all rows, low-census rows as their own class."""
    return tier_distribution(staffing.withColumn("staffing_tier", profiling_tier(settings)))


def tier_distribution(tiered: DataFrame) -> DataFrame:
    return (
        tiered.groupBy("staffing_tier")
        .agg(row_count().alias("days"))
        .orderBy(F.desc("days"), "staffing_tier")
    )


def tier_by_quarter(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("quarter", "staffing_tier")
        .agg(row_count().alias("days"))
        .orderBy("quarter", "staffing_tier")
    )


def tier_pass_rate(staffing: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Share of all rows, excluded ones too, in the passing tier."""
    passing = F.count_if(profiling_tier(settings) == TIER_MEETS)
    rows = row_count()
    return staffing.agg(
        rows.alias("days"),
        passing.alias("days_passing"),
        F.round(percent(passing, rows), 1).alias("pass_pct"),
    )


def chronic_offenders(
    staffing: DataFrame, n: int | None = 15, settings: Settings = DEFAULTS
) -> DataFrame:
    """Facilities by number of days in a short-staffed tier, most first."""
    group = ("PROVNUM", "PROVNAME", "STATE")
    ranked = (
        staffing.dropna(subset=list(group))
        .filter(profiling_tier(settings).isin(*TIERS_SHORT_STAFFED))
        .groupBy(*group)
        .agg(
            F.count("WorkDate").alias("days_below_minimum"),
            quotient_mean(hours_per_patient("Hrs_CNA")).alias("avg_CNA_ratio"),
            full_mean("MDScensus").alias("avg_patients"),
        )
        .orderBy(F.desc("days_below_minimum"), "PROVNUM", "PROVNAME", "STATE")
    )
    return ranked if n is None else ranked.limit(n)


def facility_means(staffing: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Mean ratios and census of each facility over its regular days."""
    return (
        enough_census(staffing, settings)
        .filter(F.col("PROVNUM").isNotNull())
        .groupBy("PROVNUM")
        .agg(
            quotient_mean(hours_per_patient("Hrs_CNA")).alias("avg_CNA_ratio"),
            quotient_mean(hours_per_patient("Hrs_RN")).alias("avg_RN_ratio"),
            quotient_mean(hours_per_patient("Hrs_RN", "Hrs_LPN", "Hrs_CNA")).alias("avg_total_ratio"),
            full_mean("MDScensus").alias("avg_census"),
            F.count("WorkDate").alias("days_in_quarter"),
        )
    )


def staffing_rating_corr(facility_table: DataFrame, provider: DataFrame) -> DataFrame:
    """Correlation of a facility's mean ratios with its overall rating.

    Announced for the quality layer but never given an input file there, so the
    rating of the provider file stands in. Both sides have one row per facility.
    """
    rated = facility_table.join(
        provider.select("CCN", "overall_rating"), F.col("PROVNUM") == F.col("CCN")
    )
    return rated.agg(
        row_count().alias("facilities"),
        *[
            F.round(F.corr(name, "overall_rating"), 6).alias(f"corr_{name}")
            for name in ("avg_CNA_ratio", "avg_RN_ratio", "avg_total_ratio")
        ],
    )
