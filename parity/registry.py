"""Every query, by the name it is checked under."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.tables import Tables
from rosterlake.config import (
    CORRELATION_KEY,
    DAY_KEY,
    FACILITY_KEY,
    PROVIDER_FIELDS,
    STAFFING_COLUMNS,
    TablePaths,
)
from rosterlake.functions.calendar import quarter_from_name
from rosterlake.operators import clean, distinct, generate, merge, profile
from rosterlake.plans import gold, serving, silver as silver_plan
from rosterlake.session import scratch_dir, staged
from rosterlake.sinks import audit, checks, landing, tables as sinks
from rosterlake.sources import csv as text
from rosterlake.sources import manifest as manifests
from rosterlake.sources import tables as layers
from rosterlake.streaming.incremental import load_new_days

Query = Callable[[SparkSession, str], DataFrame]
SCAN_QUARTER = "1998Q2"
SHIFTED_LABEL = "1998Q3"
SOME_STATES = [f"NATION_{i}" for i in (0, 2, 3, 5, 8, 13, 15, 20, 21, 24)]
SOME_OWNERS = ["For profit - Corporation", "Non profit - Other"]
SAMPLE_ROWS = 5000

RATIOS = (
    "CNA_hrs_per_patient", "RN_hrs_per_patient", "LPN_hrs_per_patient",
    "total_hrs_per_patient", "contracted_rn_ratio", "bed_occupancy_rate",
)
QUERIES: dict[str, Query] = {}
BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register ``build`` under its own name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Tables(spark, sf_dir))

    QUERIES[build.__name__] = run
    BUILDERS[build.__name__] = build
    return build


# --- sources -------------------------------------------------------------------

def land(rows: DataFrame, bronze: str) -> None:
    """Write rows as landed files, one folder per quarter. They come in ranges of quarters, so a task writes few files;
    the text, ten times as much as the tables it comes from, is packed."""
    (
        rows.write.mode("append").partitionBy("quarter").option("header", True)
        .option("encoding", "ISO-8859-1").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").csv(bronze)
    )


def land_staffing(t: Tables) -> str:
    """The staffing text as landed files."""
    bronze = scratch_dir(t.spark, "bronze")
    land(t.staffing_text(by_quarter=True).withColumn("quarter", F.col("CY_Qtr")), bronze)
    return bronze


@query
def scan_staffing(t: Tables) -> DataFrame:
    """Files of two headers in one landing folder: half the quarters have a moved and an extra column."""
    bronze = scratch_dir(t.spark, "bronze")
    late = F.substring("quarter", 6, 1).isin("3", "4")
    rows = t.staffing_text(by_quarter=True).withColumn("quarter", F.col("CY_Qtr"))
    moved = [STAFFING_COLUMNS[-1], "Extra", *STAFFING_COLUMNS[:-1], "quarter"]
    land(rows.filter(~late), bronze)
    land(rows.filter(late).withColumn("Extra", F.lit("x")).select(*moved), bronze)
    return text.scan_staffing(t.spark, bronze).select(*STAFFING_COLUMNS, "quarter")


@query
def scan_provider(t: Tables) -> DataFrame:
    folder = scratch_dir(t.spark, "provider")
    t.provider_text().write.option("header", True).option("encoding", "ISO-8859-1").csv(folder)
    raw = text.scan_provider(t.spark, folder)
    return raw.select(*[
        F.col(f"`{header}`").alias(name) for header, (name, _) in PROVIDER_FIELDS.items()
    ])


@query
def silver_quarter_scan(t: Tables) -> DataFrame:
    """From stored Silver, of which only one quarter's folders are read."""
    path = scratch_dir(t.spark, "silver")
    sinks.insert_only(t.spark, t.silver(), path, DAY_KEY, silver_plan.SILVER_PARTITIONS, "WorkDate")
    return layers.read_quarter(t.spark, path, SCAN_QUARTER)


@query
def extract_quarter(t: Tables) -> DataFrame:
    return t.manifest().select("name", quarter_from_name(F.col("name")).alias("quarter"))


@query
def new_quarters(t: Tables) -> DataFrame:
    return manifests.new_quarters(t.manifest(), t.landed_quarters())


@query
def assign_files(t: Tables) -> DataFrame:
    files = t.manifest()
    return manifests.assign_files(files, manifests.new_quarters(files, t.landed_quarters()))


@query
def discover_files(t: Tables) -> DataFrame:
    """Offered files and landed quarters, both listed from written folders. The drop folder has one
    entry for each name without its number, so it stays small at any scale."""
    drop, bronze = scratch_dir(t.spark, "drop"), scratch_dir(t.spark, "landed")
    stems = t.manifest().select(F.regexp_replace("name", r"-[0-9]+\.csv$", ".csv").alias("name")).distinct()
    stems.select(F.lit("x").alias("value"), "name").write.partitionBy("name").text(drop)
    t.landed_quarters().select(F.lit("x").alias("value"), "quarter").write.partitionBy("quarter").text(bronze)
    offered = manifests.offered_files(t.spark, drop).select(
        F.regexp_extract("id", "name=([^/]+)/", 1).alias("name")
    )
    fresh = manifests.new_quarters(offered, manifests.landed_quarters(t.spark, bronze))
    return manifests.assign_files(offered, fresh).select("name", "quarter")


@query
def landed_files(t: Tables) -> DataFrame:
    """Offered files copied to where they belong, read back from there as bytes. A file holds how many orders have its
    name without the number, and the sum of their keys."""
    drop, bronze = scratch_dir(t.spark, "drop"), scratch_dir(t.spark, "landing")
    stems = t.manifest().groupBy(F.regexp_replace("name", r"-[0-9]+\.csv$", ".csv").alias("name")).agg(
        F.concat_ws(",", F.count("id").cast("string"), F.sum("id").cast("string")).alias("value")
    )
    stems.write.partitionBy("name").text(drop)
    offered = manifests.offered_files(t.spark, drop).select("id", F.regexp_extract("id", "name=([^/]+)/", 1).alias("name"))
    landing.land_files(t.spark, manifests.assign_files(offered, manifests.new_quarters(offered, t.landed_quarters())), bronze)
    back = t.spark.read.format("binaryFile").load(bronze)
    return back.select("quarter", F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.sha2("content", 256).alias("sha256"))


@query
def sample_n(t: Tables) -> DataFrame:
    return profile.first_rows(t.staffing(), SAMPLE_ROWS)


@query
def schema_report(t: Tables) -> DataFrame:
    return profile.schema_report(t.staffing())


def join_raw_provider(t: Tables) -> DataFrame:
    """Staffing beside the provider file as it comes, one wanted column short."""
    return clean.lookup_join(
        t.staffing(), t.provider_text().drop("Total nursing staff turnover"),
        "PROVNUM", "CMS Certification Number (CCN)", spread_by=("WorkDate", "MDScensus"),
    )


@query
def column_presence(t: Tables) -> DataFrame:
    return profile.column_presence(join_raw_provider(t))


@query
def joined_preview(t: Tables) -> DataFrame:
    return profile.joined_preview(join_raw_provider(t))


# --- sinks -----------------------------------------------------------------------

@query
def merge_insert_only(t: Tables) -> DataFrame:
    return merge.merge_insert_only(t.metrics("F"), t.metrics("O"), DAY_KEY)


@query
def merge_upsert(t: Tables) -> DataFrame:
    return merge.merge_upsert(t.facilities("F"), t.facilities("O"), FACILITY_KEY)


@query
def upsert_table(t: Tables) -> DataFrame:
    """The upsert as written: create from one delivery, merge the other, read back."""
    path = scratch_dir(t.spark, "facility-summary")
    for delivery in ("F", "O"):
        sinks.upsert(t.spark, t.facilities(delivery), path, FACILITY_KEY, "quarter")
    return layers.read_table(t.spark, path)


@query
def insert_table(t: Tables) -> DataFrame:
    """The insert-only merge as written."""
    path = scratch_dir(t.spark, "staffing-metrics")
    for delivery in ("F", "O"):
        sinks.insert_only(
            t.spark, t.metrics(delivery), path, DAY_KEY, ("quarter", "STATE"), "WorkDate"
        )
    return layers.read_table(t.spark, path)


@query
def audit_unmatched(t: Tables) -> DataFrame:
    return clean.unmatched(t.joined())


@query
def audit_table(t: Tables) -> DataFrame:
    """The audit log as written and read back."""
    path = scratch_dir(t.spark, "audit")
    sinks.append_if_any(clean.unmatched(t.joined()), path)
    return layers.read_table(t.spark, path)


@query
def audit_reconciled(t: Tables) -> DataFrame:
    """One quarter by the batch run, twice; then everything by the stream, twice, each time with a new checkpoint; all into one Silver
    and one audit log. Then the books of each quarter, over rows with a readable day (others are inserted again by definition)."""
    bronze, provider = land_staffing(t), scratch_dir(t.spark, "provider")
    t.provider_text().write.option("header", True).option("encoding", "ISO-8859-1").csv(provider)
    paths = TablePaths(bronze, *[scratch_dir(t.spark, name) for name in ("silver", "gold", "audit")])
    for _ in range(2):
        silver_plan.run_silver(t.spark, layers.landing_path(bronze, SCAN_QUARTER), provider, paths, SCAN_QUARTER)
    for _ in range(2):
        load_new_days(
            t.spark, bronze, t.provider(), paths.silver, scratch_dir(t.spark, "offsets"), paths.audit, files_per_batch=64, files="part-*.csv*"
        )
    # read twice below: the three columns are parsed once
    typed = staged(t.spark, clean.type_staffing(text.scan_staffing(t.spark, bronze)).select("CY_Qtr", "WorkDate", "MDScensus"), "typed")
    dated = [rows.filter("WorkDate IS NOT NULL") for rows in (
        typed, clean.enough_census(typed), layers.read_table(t.spark, paths.silver), audit.read_audit(t.spark, paths.audit)
    )]
    return audit.reconciled(*dated)


def stored_gold(t: Tables) -> TablePaths:
    """Both Gold tables as the jobs write them."""
    paths = TablePaths(*[scratch_dir(t.spark, name) for name in ("bronze", "silver", "gold", "audit")])
    sinks.upsert(t.spark, t.facilities(), paths.facility_summary, FACILITY_KEY, "quarter")
    sinks.insert_only(
        t.spark, t.metrics(), paths.staffing_metrics, DAY_KEY, silver_plan.SILVER_PARTITIONS, "WorkDate"
    )
    return paths


@query
def gold_scan(t: Tables) -> DataFrame:
    """Stored facility rows beside their stored days' number."""
    facilities, daily = layers.gold_tables(t.spark, stored_gold(t))
    days = daily.groupBy("PROVNUM", "quarter").agg(F.count("WorkDate").alias("stored_days"))
    return facilities.join(days, ["PROVNUM", "quarter"]).select(*facilities.columns, "stored_days")


@query
def validate_facility_summary(t: Tables) -> DataFrame:
    return checks.validate_facility_summary(t.spark, stored_gold(t).facility_summary)


@query
def validate_staffing_metrics(t: Tables) -> DataFrame:
    return checks.validate_staffing_metrics(t.spark, stored_gold(t).staffing_metrics)


@query
def table_size(t: Tables) -> DataFrame:
    return checks.table_size(t.spark, stored_gold(t).facility_summary)


@query
def schema_contract(t: Tables) -> DataFrame:
    """Each column of stored Silver with its standing and filled rows; one is taken away and one put in to show all."""
    path = scratch_dir(t.spark, "silver")
    sinks.create_table(t.silver(), path, silver_plan.SILVER_PARTITIONS)
    given = layers.read_table(t.spark, path).drop("provider_type").withColumn("surprise", F.lit(1))
    return clean.contract_report(given, silver_plan.SILVER_COLUMNS)


@query
def validate_silver(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "silver")
    sinks.create_table(t.silver(), path, silver_plan.SILVER_PARTITIONS)
    return checks.validate_silver(t.spark, path)


@query
def csv_export(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "export")
    sinks.export_csv(serving.drill_down(serving.facility_filter(t.facilities())), path)
    return text.scan_csv(t.spark, path, encoding="UTF-8")


# --- typing, filters, joins ----------------------------------------------------------

@query
def typed_staffing(t: Tables) -> DataFrame:
    return clean.type_staffing(t.staffing_text())


@query
def provider_select(t: Tables) -> DataFrame:
    return clean.select_provider(t.provider_text())


@query
def filter_low_census(t: Tables) -> DataFrame:
    return clean.enough_census(t.staffing())


@query
def excluded_rows(t: Tables) -> DataFrame:
    return clean.excluded_count(t.staffing())


@query
def join_provider(t: Tables) -> DataFrame:
    return t.joined()


@query
def join_provider_salted(t: Tables) -> DataFrame:
    """The same join on the path a provider table too large to broadcast takes."""
    return clean.join_provider(clean.enough_census(t.staffing()), t.provider(), small=False)


@query
def matched_rows(t: Tables) -> DataFrame:
    return clean.matched(t.joined())


@query
def join_coverage(t: Tables) -> DataFrame:
    return clean.join_coverage(t.staffing(), t.provider())


@query
def unmatched_ids(t: Tables) -> DataFrame:
    return clean.unmatched_ids(t.staffing(), t.provider())


@query
def provider_conflicts(t: Tables) -> DataFrame:
    """What an untidy provider file says twice."""
    return clean.provider_conflicts(t.provider_listed())


@query
def join_unique_provider(t: Tables) -> DataFrame:
    """The join with an untidy provider file: as many rows as with a tidy one."""
    providers = clean.unique_providers(t.provider_listed())
    return clean.join_provider(clean.enough_census(t.staffing()), providers, t.provider_is_small())


@query
def silver(t: Tables) -> DataFrame:
    return t.silver()


# --- daily columns ---------------------------------------------------------------------

@query
def daily_ratios(t: Tables) -> DataFrame:
    return t.daily().select(*DAY_KEY, *RATIOS)


@query
def staffing_tier(t: Tables) -> DataFrame:
    return t.silver().select(*DAY_KEY, "CNA_hrs_per_patient", "staffing_tier")


@query
def daily_compliance(t: Tables) -> DataFrame:
    return t.daily().select(*DAY_KEY, "meets_cms_minimums", "day_of_week", "is_weekend")


@query
def staffing_metrics(t: Tables) -> DataFrame:
    return t.metrics()


@query
def shift_quarter(t: Tables) -> DataFrame:
    moved = generate.shift_quarter(t.staffing(), SHIFTED_LABEL)
    return moved.select(*DAY_KEY, "CY_Qtr", "MDScensus")


@query
def shift_quarter_full(t: Tables) -> DataFrame:
    moved = generate.shift_quarter(t.staffing(), SHIFTED_LABEL, every_day=True)
    return moved.select(*DAY_KEY, "CY_Qtr", "MDScensus")


# --- gold and serving --------------------------------------------------------------------

@query
def facility_summary(t: Tables) -> DataFrame:
    return t.facilities()


@query
def quality_correlations(t: Tables) -> DataFrame:
    """The correlation table as a job stores it, one quarter after the other once and all again at once."""
    path = scratch_dir(t.spark, "correlations")
    facilities = staged(t.spark, t.facilities(), "facilities")
    first = layers.in_quarter(facilities, SCAN_QUARTER)
    for rows in (first, facilities):
        sinks.upsert(t.spark, gold.quality_correlations(rows), path, CORRELATION_KEY, "quarter")
    return layers.read_table(t.spark, path)


@query
def tier_distribution(t: Tables) -> DataFrame:
    return profile.tier_distribution(t.silver())


@query
def tier_by_quarter(t: Tables) -> DataFrame:
    return profile.tier_by_quarter(t.silver())


@query
def chronic_by_state(t: Tables) -> DataFrame:
    return serving.chronic_by_state(t.facilities())


@query
def facility_compliance_rate(t: Tables) -> DataFrame:
    return serving.facility_compliance_rate(t.facilities())


@query
def daily_compliance_rate(t: Tables) -> DataFrame:
    return serving.daily_compliance_rate(t.metrics())


@query
def facility_filter(t: Tables) -> DataFrame:
    return serving.facility_filter(t.facilities(), SOME_STATES, SOME_OWNERS, understaffed_only=True)


@query
def filter_options(t: Tables) -> DataFrame:
    return serving.filter_options(t.facilities())


@query
def filter_summary(t: Tables) -> DataFrame:
    return serving.filter_summary(serving.facility_filter(t.facilities(), SOME_STATES, SOME_OWNERS))


@query
def kpi_cards(t: Tables) -> DataFrame:
    return serving.kpi_cards(serving.facility_filter(t.facilities()))


@query
def q1_scatter(t: Tables) -> DataFrame:
    return serving.occupancy_scatter(serving.facility_filter(t.facilities()))


@query
def contract_by_state(t: Tables) -> DataFrame:
    return serving.contract_by_state(serving.facility_filter(t.facilities()))


@query
def cna_by_state(t: Tables) -> DataFrame:
    return serving.cna_by_state(serving.facility_filter(t.facilities()))


@query
def cna_by_ownership(t: Tables) -> DataFrame:
    return serving.cna_by_ownership(serving.facility_filter(t.facilities()))


@query
def weekly_trend(t: Tables) -> DataFrame:
    return serving.weekly_trend(t.metrics())


@query
def weekly_trend_long(t: Tables) -> DataFrame:
    return serving.weekly_trend_long(serving.weekly_trend(t.metrics(), SOME_STATES))


@query
def drill_down(t: Tables) -> DataFrame:
    return serving.drill_down(serving.facility_filter(t.facilities()))


@query
def worst_facilities(t: Tables) -> DataFrame:
    return serving.worst_facilities(t.facilities())


# --- profiling ------------------------------------------------------------------------------

@query
def identity_profile(t: Tables) -> DataFrame:
    return profile.identity_profile(t.staffing())


@query
def identity_from_bitmaps(t: Tables) -> DataFrame:
    """Distinct facilities, states and cities from stored bitmaps: one delivery, the other, and the first again; then all
    quarters together, and one of them alone."""
    folder = scratch_dir(t.spark, "distinct")
    rows = staged(t.spark, t.staffing().select("PROVNUM", "STATE", "CITY", "CY_Qtr"), "identities")
    early = rows.filter(F.col("CY_Qtr") < SCAN_QUARTER)
    for load in (early, rows.filter(F.col("CY_Qtr") >= SCAN_QUARTER), early):
        distinct.add_load(t.spark, load, folder, "CY_Qtr", ("PROVNUM", "STATE", "CITY"))
    bitmaps = distinct.read_bitmaps(t.spark, folder)
    alone = bitmaps.filter(F.col("CY_Qtr") == SCAN_QUARTER)
    return distinct.distinct_counts(bitmaps).withColumn("scope", F.lit("all")).unionByName(
        distinct.distinct_counts(alone).withColumn("scope", F.lit(SCAN_QUARTER)))


@query
def state_list(t: Tables) -> DataFrame:
    return profile.value_list(t.staffing(), "STATE")


@query
def quarter_list(t: Tables) -> DataFrame:
    return profile.value_list(t.staffing(), "CY_Qtr")


@query
def duplicate_keys(t: Tables) -> DataFrame:
    """Two deliveries appended without a merge repeat their common facility-days."""
    return profile.duplicate_keys(t.staffing("F").unionByName(t.staffing("O")))


@query
def missing_report(t: Tables) -> DataFrame:
    return profile.missing_report(clean.type_staffing(t.staffing_text()))


@query
def zero_report(t: Tables) -> DataFrame:
    return profile.zero_report(t.staffing())


@query
def describe_stats(t: Tables) -> DataFrame:
    return profile.describe_stats(t.staffing())


@query
def outlier_check(t: Tables) -> DataFrame:
    return profile.outlier_check(t.staffing())


@query
def facilities_per_state(t: Tables) -> DataFrame:
    return profile.facilities_per_state(t.staffing())


@query
def census_histogram(t: Tables) -> DataFrame:
    return profile.census_histogram(t.staffing())


@query
def hours_by_type(t: Tables) -> DataFrame:
    return profile.hours_by_type(t.staffing())


@query
def tier_profile(t: Tables) -> DataFrame:
    return profile.tier_profile(clean.type_staffing(t.staffing_text()))


@query
def tier_pass_rate(t: Tables) -> DataFrame:
    return profile.tier_pass_rate(t.staffing())


@query
def chronic_offenders(t: Tables) -> DataFrame:
    return profile.chronic_offenders(t.staffing())


@query
def facility_means(t: Tables) -> DataFrame:
    return profile.facility_means(t.staffing())


@query
def staffing_rating_corr(t: Tables) -> DataFrame:
    return profile.staffing_rating_corr(profile.facility_means(t.staffing()), t.provider())


# --- incremental --------------------------------------------------------------------------------

def stream(t: Tables, silver: str, audit: str) -> None:
    """Several micro-batches; Spark names the landed files itself."""
    load_new_days(
        t.spark, land_staffing(t), t.provider(), silver, scratch_dir(t.spark, "offsets"), audit,
        files_per_batch=16, files="part-*.csv*",
    )


@query
def incremental_load(t: Tables) -> DataFrame:
    """Landed text files through the stream into Silver, in several micro-batches."""
    path = scratch_dir(t.spark, "silver")
    stream(t, path, scratch_dir(t.spark, "audit"))
    return layers.read_table(t.spark, path)


@query
def incremental_audit(t: Tables) -> DataFrame:
    """What the same stream leaves in the audit log."""
    path = scratch_dir(t.spark, "audit")
    stream(t, scratch_dir(t.spark, "silver"), path)
    return audit.read_audit(t.spark, path)


@query
def generated_quarter(t: Tables) -> DataFrame:
    """A test delivery written as CSV and read as any other."""
    path = scratch_dir(t.spark, "generated")
    generate.write_next_quarter(t.staffing(), path, SHIFTED_LABEL, SAMPLE_ROWS)
    return clean.type_staffing(text.scan_staffing(t.spark, path))
