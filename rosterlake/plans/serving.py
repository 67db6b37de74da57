"""Questions asked of the Gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.config import (
    DEFAULTS,
    DRILL_DOWN_LABELS,
    DRILL_DOWN_TWO_DECIMALS,
    TREND_LABELS,
    Settings,
)
from rosterlake.functions.calendar import week_start
from rosterlake.functions.numeric import exact_percent, exact_sum, full_mean, percent, row_count

def _top(ranked: DataFrame, n: int | None) -> DataFrame:
    return ranked if n is None else ranked.limit(n)


# --- filters ---------------------------------------------------------------------

def facility_filter(
    facilities: DataFrame,
    states: Sequence[str] | None = None,
    ownership: Sequence[str] | None = None,
    understaffed_only: bool = False,
) -> DataFrame:
    """The rows a viewer selected. None selects every value, but never a NULL one."""
    chosen = facilities
    for column, values in (("STATE", states), ("ownership_type", ownership)):
        name = F.col(column)
        chosen = chosen.filter(name.isNotNull() if values is None else name.isin(*values))
    return chosen.filter(F.col("chronically_understaffed")) if understaffed_only else chosen


def filter_options(facilities: DataFrame) -> DataFrame:
    """The values a viewer may select: sorted states and ownership types.

    Facilities fold to their (state, ownership) pairs first; both lists come from those.
    """
    pairs = facilities.select("STATE", "ownership_type").distinct()
    return (
        pairs.unpivot([], ["STATE", "ownership_type"], "filter", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("filter", "value")
    )


def filter_summary(facilities: DataFrame) -> DataFrame:
    """Size of the selection and the latest quarter in it."""
    return facilities.agg(
        row_count().alias("facilities_shown"),
        F.count_distinct("STATE").alias("states_selected"),
        F.max("quarter").alias("quarter"),
    )


# --- headline figures --------------------------------------------------------------

def kpi_cards(facilities: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Headline figures, unweighted over facilities; all NULL for an empty selection.

    Days NULL count as not meeting; the chronic count skips NULL flags.
    """
    rows = row_count()
    chronic = F.count_if("chronically_understaffed")
    figures = facilities.agg(
        rows.alias("facilities"),
        percent(F.count_if(F.col("pct_days_meeting_cms") >= settings.chronic_cutoff), rows)
        .alias("pct_meeting"),
        chronic.alias("chronic"),
        percent(chronic, rows).alias("pct_chronic"),
        full_mean("avg_CNA_hrs_per_patient").alias("avg_cna"),
        full_mean("avg_RN_hrs_per_patient").alias("avg_rn"),
        full_mean("avg_total_hrs_per_patient").alias("avg_total"),
        (full_mean("avg_bed_occupancy_rate") * 100).alias("avg_occupancy_pct"),
        (full_mean("avg_contracted_rn_ratio") * 100).alias("avg_contracted_pct"),
        full_mean("weekend_staffing_gap").alias("avg_weekend_gap"),
    )
    return figures.withColumns({
        "cna_vs_minimum": F.col("avg_cna") - settings.cna_minimum,
        "rn_vs_minimum": F.col("avg_rn") - settings.rn_minimum,
        "total_vs_minimum": F.col("avg_total") - settings.total_minimum,
    })


def facility_compliance_rate(facilities: DataFrame) -> DataFrame:
    """Share of facilities that are not chronically understaffed; NULL flags are not."""
    total = row_count()
    compliant = F.count_if(~F.col("chronically_understaffed"))
    return facilities.agg(
        total.alias("total"),
        compliant.alias("compliant"),
        F.round(percent(compliant, total), 1).alias("compliant_pct"),
    )


def daily_compliance_rate(daily: DataFrame) -> DataFrame:
    total = row_count()
    meeting = F.count_if("meets_cms_minimums")
    return daily.agg(
        total.alias("days"),
        meeting.alias("days_meeting"),
        F.round(percent(meeting, total), 1).alias("meeting_pct"),
    )


# --- charts --------------------------------------------------------------------------

def occupancy_scatter(facilities: DataFrame) -> DataFrame:
    """Occupancy against CNA hours; more patients than beds is a data fault."""
    return facilities.filter(F.col("avg_bed_occupancy_rate") <= 1.0).select(
        "PROVNAME", "STATE", "ownership_type", "avg_bed_occupancy_rate",
        "avg_CNA_hrs_per_patient", "chronically_understaffed",
    )


def contract_by_state(facilities: DataFrame, n: int | None = 20) -> DataFrame:
    """Contract RN use of each state, heaviest first.

    ``avg_employed`` and ``avg_contract_hrs`` are sums: names kept for compatibility.
    """
    by_state = facilities.filter(F.col("STATE").isNotNull()).groupBy("STATE").agg(
        full_mean("avg_contracted_rn_ratio").alias("avg_contracted"),
        exact_sum("total_employed_RN_hours", 1).alias("avg_employed"),
        exact_sum("total_contracted_RN_hours", 1).alias("avg_contract_hrs"),
        F.count("PROVNUM").alias("facility_count"),
        exact_percent("avg_contracted_rn_ratio", 1).alias("contracted_pct"),
    )
    return _top(by_state.orderBy(F.desc("contracted_pct"), "STATE"), n)


def cna_by_state(facilities: DataFrame, n: int | None = 15) -> DataFrame:
    """Mean CNA hours of each state, lowest first."""
    return _top(_mean_cna(facilities, "STATE"), n)


def cna_by_ownership(facilities: DataFrame) -> DataFrame:
    return _mean_cna(facilities, "ownership_type")


def _mean_cna(facilities: DataFrame, group: str) -> DataFrame:
    return (
        facilities.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(
            full_mean("avg_CNA_hrs_per_patient").alias("avg_cna"),
            F.count("PROVNUM").alias("facility_count"),
        )
        .orderBy(F.asc_nulls_last("avg_cna"), group)
    )


def weekly_trend(daily: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    """Mean hours per patient of each week, over the selected states only."""
    rows = daily if states is None else daily.filter(F.col("STATE").isin(*states))
    return (
        rows.groupBy(week_start(F.col("WorkDate")).alias("week"))
        .agg(
            full_mean("CNA_hrs_per_patient").alias("avg_cna"),
            full_mean("RN_hrs_per_patient").alias("avg_rn"),
            full_mean("total_hrs_per_patient").alias("avg_total"),
        )
        .filter(F.col("week").isNotNull())
        .orderBy("week")
    )


def weekly_trend_long(trend: DataFrame) -> DataFrame:
    """The weekly means as (week, staff type, value) rows for a line chart."""
    label = F.create_map(*[F.lit(x) for pair in TREND_LABELS.items() for x in pair])
    return trend.unpivot("week", list(TREND_LABELS), "staff_type", "hrs_per_patient").withColumn(
        "staff_type", label[F.col("staff_type")]
    )


# --- rankings and tables ----------------------------------------------------------------

def chronic_by_state(facilities: DataFrame, n: int | None = 10) -> DataFrame:
    ranked = (
        facilities.filter(F.col("chronically_understaffed"))
        .groupBy("STATE")
        .agg(row_count().alias("facilities"))
        .orderBy(F.desc("facilities"), "STATE")
    )
    return _top(ranked, n)


def worst_facilities(facilities: DataFrame, n: int | None = 10) -> DataFrame:
    """Chronically understaffed facilities with the fewest compliant days."""
    ranked = facilities.filter(F.col("chronically_understaffed")).orderBy(
        "pct_days_meeting_cms", "PROVNUM", "quarter"
    )
    return _top(ranked, n).select(
        "PROVNAME", "STATE", "avg_CNA_hrs_per_patient", "pct_days_meeting_cms", "avg_daily_census"
    )


def drill_down(facilities: DataFrame) -> DataFrame:
    """The facility table as shown to people: labelled, two decimals, lowest CNA hours first."""
    shown = facilities.select(*[
        (F.bround(name, 2) if name in DRILL_DOWN_TWO_DECIMALS else F.col(name)).alias(label)
        for name, label in DRILL_DOWN_LABELS.items()
    ])
    return shown.orderBy(F.asc_nulls_last("CNA Hrs"), "CCN")
