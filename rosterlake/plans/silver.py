"""Bronze text to the Silver table and the audit log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rosterlake.config import (
    DAY_KEY,
    DEFAULTS,
    PROVIDER_FIELDS,
    STAFFING_COLUMNS,
    Settings,
    TablePaths,
)
from rosterlake.functions.staffing import ratio_columns, staffing_tier
from rosterlake.operators.clean import (
    enough_census,
    join_provider,
    matched,
    require_columns,
    select_provider,
    type_staffing,
    unique_providers,
    unmatched,
)
from rosterlake.operators.joins import fits_broadcast
from rosterlake.functions.numeric import row_count
from rosterlake.session import scratch, staged
from rosterlake.sinks.audit import SOURCE_FILE, replace_audit
from rosterlake.sinks.tables import insert_only
from rosterlake.sources.csv import scan_provider, scan_staffing, staffing_files

SILVER_COLUMNS = (
    *STAFFING_COLUMNS,
    *[name for name, _ in PROVIDER_FIELDS.values()],
    "CNA_hrs_per_patient", "RN_hrs_per_patient", "total_hrs_per_patient",
    "contracted_rn_ratio", "staffing_tier", "quarter",
)
SILVER_PARTITIONS = ("quarter", "STATE")


def silver_rows(joined: DataFrame, quarter: str | Column, settings: Settings = DEFAULTS) -> DataFrame:
    """Matched rows with unrounded ratios, tier and quarter.

    Keeping only rows with a provider lets Catalyst turn the left join into an inner one.
    """
    label = F.lit(quarter) if isinstance(quarter, str) else quarter
    return (
        matched(joined)
        .withColumns(ratio_columns())
        .withColumns({
            "staffing_tier": staffing_tier(F.col("CNA_hrs_per_patient"), settings),
            "quarter": label,
        })
    )


def build_silver(
    staffing: DataFrame,
    provider: DataFrame,
    quarter: str | Column,
    small_provider: bool | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Typed staffing and provider rows to Silver rows."""
    joined = join_provider(enough_census(staffing, settings), provider, small_provider, settings)
    return silver_rows(joined, quarter, settings)


@dataclass(frozen=True)
class SilverReport:
    """What a load has seen. ``stamp_mismatches``: rows whose own quarter (CY_Qtr) is not the one they are stamped with."""

    raw_rows: int
    excluded_rows: int
    unmatched_rows: int
    matched_rows: int
    stamp_mismatches: int = 0


def load_joined(
    spark: SparkSession, files: str | list[str], provider: DataFrame, small: bool, folder: str,
    quarter: Column | None = None, settings: Settings = DEFAULTS,
) -> tuple[DataFrame, SilverReport]:
    """Staffing files typed, cut at the census floor and joined, as a table in ``folder`` with the file of each row
    (``source_file``); and the load's counts.

    The counts are observed where the rows pass on their way into that table: no job of their own, no second reading.
    A CCN that the provider file lists more than once is joined once (``unique_providers``).
    """
    typed = type_staffing(scan_staffing(spark, files, SOURCE_FILE))
    if quarter is None and "quarter" not in typed.columns:  # no file with a line in it
        typed = typed.withColumn("quarter", F.lit(None).cast("string"))
    raw, split = Observation(), Observation()
    typed = typed.observe(
        raw, row_count().alias("raw_rows"), F.count_if(F.col("MDScensus") >= settings.census_floor).alias("kept_rows"),
        F.count_if(~F.col("CY_Qtr").eqNullSafe(F.col("quarter") if quarter is None else quarter)).alias("stamp_mismatches"),
    )
    kept = enough_census(typed, settings)
    if not small:  # such a join reads its rows several times, and again for a lost task: not the text
        kept = staged(spark, kept, "typed", folder)
    joined = join_provider(kept, unique_providers(provider), small, settings).observe(
        split, F.count("CCN").alias("matched_rows"), F.count_if(F.col("CCN").isNull()).alias("unmatched_rows")
    )
    joined = staged(spark, joined, "joined", folder)
    counts = raw.get | split.get
    return joined, SilverReport(
        raw_rows=counts["raw_rows"],
        excluded_rows=counts["raw_rows"] - counts["kept_rows"],
        unmatched_rows=counts["unmatched_rows"],
        matched_rows=counts["matched_rows"],
        stamp_mismatches=counts["stamp_mismatches"],
    )


def store_joined(
    spark: SparkSession, joined: DataFrame, files: list[str], silver_path: str, audit_path: str, quarter: str | Column, settings: Settings = DEFAULTS
) -> None:
    """The joined rows of some files to the audit log and to Silver. Both can be repeated: the log replaces what it holds of these
    files, Silver adds only days it lacks."""
    replace_audit(spark, unmatched(joined).drop("quarter"), audit_path, files)
    silver = require_columns(silver_rows(joined.drop(SOURCE_FILE), quarter, settings), SILVER_COLUMNS)
    insert_only(spark, silver, silver_path, DAY_KEY, SILVER_PARTITIONS, range_column="WorkDate")


def run_silver(
    spark: SparkSession,
    staffing_csv: str | list[str],
    provider_csv: str | list[str],
    paths: TablePaths,
    quarter: str,
    settings: Settings = DEFAULTS,
) -> SilverReport:
    """Load one delivery: audit its unmatched rows, add its new days to Silver.

    The text is parsed once and joined once, each into a columnar table in the shared scratch
    folder. Audit and Silver read the latter, so neither goes back to the CSV or joins
    again, and a lost executor repeats only its own tasks. The copies are removed at the end.

    A delivery can be loaded again without harm, also by the stream: Silver adds nothing twice, and the audit log
    replaces the rows of the same files.
    """
    files = staffing_files(spark, staffing_csv)
    with scratch(spark, "silver-run") as folder:
        provider = select_provider(scan_provider(spark, provider_csv))
        small = fits_broadcast(provider, settings)
        joined, report = load_joined(spark, staffing_csv, provider, small, folder, F.lit(quarter), settings)
        store_joined(spark, joined, files, paths.silver, paths.audit, quarter, settings)
    return report
