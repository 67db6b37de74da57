"""Parameters, fixed vocabularies and table locations.

Nothing here touches Spark: every other module takes a ``Settings`` and falls
back to the defaults below.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: published names of the staffing file ----------------------
ROLES = ("RNDON", "RNadmin", "RN", "LPNadmin", "LPN", "CNA", "NAtrn", "MedAide")
HOUR_COLUMNS = tuple(
    f"Hrs_{role}{suffix}" for role in ROLES for suffix in ("", "_emp", "_ctr")
)
STAFFING_COLUMNS = (
    "PROVNUM", "PROVNAME", "CITY", "STATE", "COUNTY_NAME", "COUNTY_FIPS",
    "CY_Qtr", "WorkDate", "MDScensus", *HOUR_COLUMNS,
)

# --- fixed values: provider file header -> (short name, type) ----------------
PROVIDER_FIELDS = {
    "CMS Certification Number (CCN)": ("CCN", "string"),
    "Ownership Type": ("ownership_type", "string"),
    "Provider Type": ("provider_type", "string"),
    "Number of Certified Beds": ("certified_beds", "double"),
    "Overall Rating": ("overall_rating", "double"),
    "Staffing Rating": ("staffing_rating", "double"),
    "Total nursing staff turnover": ("nursing_turnover", "double"),
    "Reported RN Staffing Hours per Resident per Day": ("reported_rn_hrs", "double"),
    "Reported Nurse Aide Staffing Hours per Resident per Day": ("reported_cna_hrs", "double"),
}

# --- fixed values: tier labels ------------------------------------------------
TIER_LOW_CENSUS = "exclude_low_census"
TIER_NO_RATIO = "exclude_zero_census"
TIER_NO_STAFF = "critical_no_staff"
TIER_CRITICAL = "critical_understaffed"
TIER_BELOW = "below_cms_minimum"
TIER_MEETS = "meets_cms_minimum"
TIERS_SHORT_STAFFED = (TIER_NO_STAFF, TIER_CRITICAL, TIER_BELOW)

# --- fixed values: file naming -------------------------------------------------
STAFFING_FILE_MARK = "PBJ_Daily_Nurse_Staffing"
QUARTER_IN_NAME = r"Q(\d)_(\d{4})"
CSV_ENCODING = "ISO-8859-1"
WORK_DATE_FORMAT = "yyyyMMdd"

# --- fixed values: days of each month that the quarter generator moves ----------
SHIFTED_DAYS = {4: 30, 5: 10, 6: 10}

# --- fixed values: keys and column sets of the derived tables -------------------
DAY_KEY = ("PROVNUM", "WorkDate")
FACILITY_KEY = ("PROVNUM", "quarter")
CORRELATION_KEY = ("quarter", "measure", "quality")
FACILITY_GROUP = (
    "PROVNUM", "PROVNAME", "STATE", "CITY", "ownership_type", "provider_type",
    "certified_beds", "overall_rating", "staffing_rating", "nursing_turnover",
    "quarter",
)
DAILY_METRIC_COLUMNS = (
    "PROVNUM", "PROVNAME", "STATE", "WorkDate", "quarter", "MDScensus",
    "CNA_hrs_per_patient", "RN_hrs_per_patient", "LPN_hrs_per_patient",
    "total_hrs_per_patient", "bed_occupancy_rate", "contracted_rn_ratio",
    "meets_cms_minimums", "staffing_tier", "is_weekend", "day_of_week",
    "ownership_type", "overall_rating", "certified_beds",
)
# Staffing measures of a facility's quarter, and the qualities they are set against.
CORRELATED_MEASURES = (
    "avg_CNA_hrs_per_patient", "avg_RN_hrs_per_patient", "avg_total_hrs_per_patient",
    "avg_contracted_rn_ratio", "pct_days_meeting_cms", "weekend_staffing_gap",
)
CORRELATED_QUALITIES = ("overall_rating", "staffing_rating", "nursing_turnover")
# What the profiling report looks for after the provider join.
EXPECTED_AFTER_JOIN = (
    "PROVNUM", "PROVNAME", "STATE", "CMS Certification Number (CCN)",
    "Number of Certified Beds", "Overall Rating", "Ownership Type",
    "Total nursing staff turnover",
    "Reported RN Staffing Hours per Resident per Day",
)
STATS_COLUMNS = ("MDScensus", "Hrs_RN", "Hrs_LPN", "Hrs_CNA")
NURSE_TYPE_LABELS = {
    "RN": "Hrs_RN",
    "LPN": "Hrs_LPN",
    "CNA": "Hrs_CNA",
    "RN Admin": "Hrs_RNadmin",
    "LPN Admin": "Hrs_LPNadmin",
    "Med Aide": "Hrs_MedAide",
    "NA Trainee": "Hrs_NAtrn",
}
TREND_LABELS = {"avg_cna": "CNA", "avg_rn": "RN", "avg_total": "Total Nurses"}
DRILL_DOWN_LABELS = {
    "PROVNUM": "CCN",
    "PROVNAME": "Facility Name",
    "STATE": "State",
    "CITY": "City",
    "ownership_type": "Ownership",
    "certified_beds": "Beds",
    "avg_daily_census": "Avg Census",
    "avg_bed_occupancy_rate": "Occupancy",
    "avg_CNA_hrs_per_patient": "CNA Hrs",
    "avg_RN_hrs_per_patient": "RN Hrs",
    "avg_total_hrs_per_patient": "Total Hrs",
    "pct_days_meeting_cms": "% Days Meeting CMS",
    "chronically_understaffed": "Understaffed",
    "overall_rating": "Star Rating",
    "avg_contracted_rn_ratio": "Contracted Ratio",
    "weekend_staffing_gap": "Weekend Gap",
}
DRILL_DOWN_TWO_DECIMALS = (
    "avg_bed_occupancy_rate", "avg_CNA_hrs_per_patient", "avg_RN_hrs_per_patient",
    "avg_total_hrs_per_patient", "avg_contracted_rn_ratio", "weekend_staffing_gap",
)


@dataclass(frozen=True)
class Settings:
    """Thresholds of the domain and the size limits of the physical choices."""

    census_floor: int = 10
    cna_minimum: float = 2.45
    rn_minimum: float = 0.55
    total_minimum: float = 3.48
    critical_ratio: float = 1.0
    chronic_cutoff: float = 50.0
    outlier_hours: float = 500.0
    census_clip: int = 300
    histogram_bins: int = 50

    # A lookup is broadcast only when it was measured to be inside both bounds; otherwise
    # it is shuffled, and keys with more than ``hot_share`` of all rows are split.
    broadcast_max_rows: int = 500_000
    broadcast_max_bytes: int = 64 * 1024 * 1024
    hot_share: float = 0.001


@dataclass(frozen=True)
class TablePaths:
    """Where one deployment keeps its layers."""

    bronze: str
    silver: str
    gold: str
    audit: str

    @property
    def facility_summary(self) -> str:
        return f"{self.gold.rstrip('/')}/facility_summary"

    @property
    def quality_correlations(self) -> str:
        return f"{self.gold.rstrip('/')}/quality_correlations"

    @property
    def staffing_metrics(self) -> str:
        return f"{self.gold.rstrip('/')}/staffing_metrics"


DEFAULTS = Settings()
