"""Ratios, tiers and compliance flags of one facility-day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterlake.config import (
    DEFAULTS,
    TIER_BELOW,
    TIER_CRITICAL,
    TIER_LOW_CENSUS,
    TIER_MEETS,
    TIER_NO_RATIO,
    TIER_NO_STAFF,
    Settings,
)


def hours_per_patient(*hours: str) -> Column:
    """Sum of hour columns over census; NULL without patients or with a NULL part."""
    total = F.col(hours[0])
    for name in hours[1:]:
        total = total + F.col(name)
    census = F.col("MDScensus")
    return F.when(census > 0, total / census)


def contracted_share() -> Column:
    """Contract share of RN hours; days without RN hours count as zero."""
    worked = F.col("Hrs_RN")
    return F.when(worked > 0, F.col("Hrs_RN_ctr") / worked).otherwise(F.lit(0.0))


def bed_occupancy() -> Column:
    beds = F.col("certified_beds")
    return F.when(beds > 0, F.col("MDScensus") / beds)


def ratio_columns() -> dict[str, Column]:
    """The unrounded ratios kept in Silver."""
    return {
        "CNA_hrs_per_patient": hours_per_patient("Hrs_CNA"),
        "RN_hrs_per_patient": hours_per_patient("Hrs_RN"),
        "total_hrs_per_patient": hours_per_patient("Hrs_RN", "Hrs_LPN", "Hrs_CNA"),
        "contracted_rn_ratio": contracted_share(),
    }


def daily_ratio_columns(digits: int = 4) -> dict[str, Column]:
    """The rounded ratios of the Gold daily table."""
    exact = {
        **ratio_columns(),
        "LPN_hrs_per_patient": hours_per_patient("Hrs_LPN"),
        "bed_occupancy_rate": bed_occupancy(),
    }
    return {name: F.round(value, digits) for name, value in exact.items()}


def staffing_tier(ratio: Column, settings: Settings = DEFAULTS) -> Column:
    """Five-way tier of a CNA ratio. A NaN ratio is above every bound."""
    tier = F.when(ratio.isNull(), TIER_NO_RATIO).when(ratio == 0, TIER_NO_STAFF)
    for bound, label in (
        (settings.critical_ratio, TIER_CRITICAL),
        (settings.cna_minimum, TIER_BELOW),
    ):
        tier = tier.when(ratio < bound, label)
    return tier.otherwise(TIER_MEETS)


def profiling_tier(settings: Settings = DEFAULTS) -> Column:
    """Tier over unfiltered rows: low census is its own, first, class."""
    low = F.col("MDScensus") < settings.census_floor
    return F.when(low, TIER_LOW_CENSUS).otherwise(
        staffing_tier(hours_per_patient("Hrs_CNA"), settings)
    )


def meets_minimums(settings: Settings = DEFAULTS) -> Column:
    """All three minimums on the rounded ratios, with SQL's three-valued AND."""
    return (
        (F.col("CNA_hrs_per_patient") >= settings.cna_minimum)
        & (F.col("RN_hrs_per_patient") >= settings.rn_minimum)
        & (F.col("total_hrs_per_patient") >= settings.total_minimum)
    )
