"""Deliveries from CSV text through Silver to Gold, and reruns."""

from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rosterlake.config import HOUR_COLUMNS, PROVIDER_FIELDS, STAFFING_COLUMNS, TablePaths
from rosterlake.operators.clean import select_provider
from rosterlake.plans.gold import run_facility_summary, run_gold, run_staffing_metrics
from rosterlake.plans.serving import facility_filter, kpi_cards, weekly_trend
from rosterlake.plans.silver import SILVER_COLUMNS, run_silver
from rosterlake.sinks import checks
from rosterlake.sources.csv import scan_provider
from rosterlake.sources.manifest import (
    assign_files,
    landed_quarters,
    new_quarters,
    offered_files,
)
from rosterlake.sources.tables import DAY_QUARTER, gold_tables, landing_path, read_if_exists, read_quarter, read_table
from rosterlake.streaming.incremental import load_new_days

START = {"2024Q2": date(2024, 4, 1), "2024Q3": date(2024, 7, 1)}


def staffing_lines(quarter, facilities=("015009", "015010", "999999"), n=10, cna=250):
    hours = {name: "0" for name in HOUR_COLUMNS} | {
        "Hrs_RN": "60", "Hrs_RN_emp": "60", "Hrs_LPN": "80", "Hrs_CNA": str(cna)}
    lines = [",".join(STAFFING_COLUMNS)]
    for facility in facilities:
        for i in range(n):
            day = (START[quarter] + timedelta(days=i)).strftime("%Y%m%d")
            census = ["100", "100.0", "9", ""][i % 4] if facility == "015010" else "100"
            row = [facility, "Peña", "Town", "AL", "County", "001", quarter, day, census]
            lines.append(",".join(row + [hours[name] for name in HOUR_COLUMNS]))
    return "\n".join(lines) + "\n"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("latin-1"))
    return str(path)


@pytest.fixture()
def lake(tmp_path):
    header = ",".join(PROVIDER_FIELDS)
    provider = put(tmp_path / "provider.csv", f"{header}\n" + "".join(
        f"{ccn},For profit,Medicare,120,3,2,40,0.5,2\n" for ccn in ("015009", "015010")))
    paths = TablePaths(*[str(tmp_path / name) for name in ("bronze", "silver", "gold", "audit")])

    def staffing(quarter, name="PBJ_Daily_Nurse_Staffing.csv", **options):
        folder = landing_path(paths.bronze, quarter)
        return put(tmp_path / folder.removeprefix(str(tmp_path) + "/") / name, staffing_lines(quarter, **options))

    return paths, provider, staffing


def test_two_quarters_end_to_end(spark, lake):
    paths, provider, staffing = lake
    for quarter in START:
        report = run_silver(spark, staffing(quarter), provider, paths, quarter)
        assert (report.raw_rows, report.excluded_rows, report.matched_rows, report.unmatched_rows) == (30, 4, 16, 10)
        run_gold(spark, paths, quarter)
    silver = read_table(spark, paths.silver)
    assert set(silver.columns) == set(SILVER_COLUMNS) and silver.count() == 32
    assert silver.first().PROVNAME == "Peña"
    assert read_table(spark, paths.audit).count() == 20
    assert "quarter" not in read_table(spark, paths.audit).columns
    facility = read_table(spark, paths.facility_summary)
    assert sorted((r.PROVNUM, r.quarter, r.total_days_in_quarter) for r in facility.collect()) == [
        ("015009", "2024Q2", 10), ("015009", "2024Q3", 10), ("015010", "2024Q2", 6), ("015010", "2024Q3", 6),
    ]
    assert tuple(checks.validate_facility_summary(spark, paths.facility_summary).first()) == (4, 4, 100.0)
    assert tuple(checks.validate_staffing_metrics(spark, paths.staffing_metrics).first()) == (32, 32, 100.0)
    assert {r.days for r in checks.validate_silver(spark, paths.silver).collect()} == {16}
    assert tuple(checks.table_size(spark, paths.silver).first()) == (32, 48)


def test_rerun_changes_nothing_and_corrections_follow_the_merge_kind(spark, lake):
    paths, provider, staffing = lake
    file = staffing("2024Q2")
    for _ in range(2):
        run_silver(spark, file, provider, paths, "2024Q2")
        run_facility_summary(spark, paths, "2024Q2")
        run_staffing_metrics(spark, paths, "2024Q2")
    assert read_table(spark, paths.silver).count() == 16
    assert read_table(spark, paths.staffing_metrics).count() == 16
    assert read_table(spark, paths.facility_summary).count() == 2
    # corrected days are ignored by the insert-only tables; two new days arrive (the
    # other facility's are below the census floor)
    run_silver(spark, staffing("2024Q2", cna=10, n=12), provider, paths, "2024Q2")
    run_gold(spark, paths, "2024Q2")
    assert read_table(spark, paths.silver).count() == 18
    row = read_table(spark, paths.facility_summary).filter("PROVNUM = '015009'").first()
    assert (row.total_days_in_quarter, row.days_meeting_cms_minimum) == (12, 10)


def test_quarter_scan_prunes_partitions(spark, lake):
    paths, provider, staffing = lake
    for quarter in START:
        run_silver(spark, staffing(quarter), provider, paths, quarter)
    one = read_quarter(spark, paths.silver, "2024Q2")
    assert one.count() == 16
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(quarter" in plan


def test_stream_loads_each_file_once(spark, lake, tmp_path):
    paths, provider_csv, staffing = lake
    provider = select_provider(scan_provider(spark, provider_csv))

    def load():
        load_new_days(
            spark, paths.bronze, provider, paths.silver, str(tmp_path / "offsets"), paths.audit, files_per_batch=1
        )
        audited = read_table(spark, paths.audit)
        assert "quarter" not in audited.columns and audited.filter("CCN is not null").count() == 0
        return audited.count(), {tuple(r) for r in read_table(spark, paths.silver).groupBy("quarter").count().collect()}

    staffing("2024Q2")
    # supporting files lie in the same folder
    put(tmp_path / "bronze" / "quarter=2024Q2" / "NH_ProviderInfo_Oct2024.csv", "a,b\n1,2\n")
    assert load() == (10, {("2024Q2", 16)})
    assert load() == (10, {("2024Q2", 16)})
    staffing("2024Q3")
    staffing("2024Q2", name="again_PBJ_Daily_Nurse_Staffing.csv", n=12)  # overlaps what is there
    assert load() == (32, {("2024Q2", 18), ("2024Q3", 16)})


def test_repeated_batch_adds_nothing(spark, lake, tmp_path):
    """A batch whose commit was lost runs again under its id."""
    paths, provider_csv, staffing = lake
    provider = select_provider(scan_provider(spark, provider_csv))
    staffing("2024Q2")
    offsets = tmp_path / "offsets"
    for _ in range(2):
        load_new_days(spark, paths.bronze, provider, paths.silver, str(offsets), paths.audit)
        for name in ("0", ".0.crc"):
            (offsets / "commits" / name).unlink()
    assert read_table(spark, paths.audit).count() == 10
    assert read_table(spark, paths.silver).count() == 16


def test_runs_leave_no_staged_copy(spark, lake):
    paths, provider, staffing = lake
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "rosterlake"
    before = set(folder.glob("*")) if folder.exists() else set()
    for quarter in START:
        run_silver(spark, staffing(quarter), provider, paths, quarter)
        run_facility_summary(spark, paths, quarter)
    assert set(folder.glob("*")) == before


def test_insert_reads_only_the_quarters_of_the_source(spark, lake):
    paths, provider, staffing = lake
    for quarter in START:
        run_silver(spark, staffing(quarter), provider, paths, quarter)
    raw = read_table(spark, paths.silver, derived=True)
    assert {r[0] for r in raw.select(DAY_QUARTER).distinct().collect()} == {"d2024Q2", "d2024Q3"}
    plan = raw.filter(F.col(DAY_QUARTER).isin(["d2024Q2"]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and DAY_QUARTER in plan.split("PartitionFilters")[1].split("]")[0]


def test_files_and_quarters(spark):
    names = [
        "PBJ_Daily_Nurse_Staffing_Q2_2024.csv", "PBJ_Daily_Nurse_Staffing_Q3_2024.csv",
        "PBJ_Daily_Nurse_Staffing_Q4_2024.csv", "NH_ProviderInfo_Oct2024.csv", "Claims_Q3_2024.csv",
        "Claims_Q1_2024.csv", "PBJ_Daily_Nurse_Staffing_latest.csv",
    ]
    manifest = spark.createDataFrame([(n,) for n in names], "name string")
    landed = spark.createDataFrame([("2024Q2",)], "quarter string")
    fresh = new_quarters(manifest, landed)
    assert sorted(r.quarter for r in fresh.collect()) == ["2024Q3", "2024Q4"]
    assert sorted((r.name, r.quarter) for r in assign_files(manifest, fresh).collect()) == sorted([
        (names[1], "2024Q3"), (names[2], "2024Q4"), (names[4], "2024Q3"),
        (names[3], "2024Q3"), (names[3], "2024Q4"), (names[6], "2024Q3"), (names[6], "2024Q4"),
    ])
    assert assign_files(manifest, new_quarters(manifest, fresh.union(landed))).count() == 0


def test_drop_folder_against_landing_folder(spark, lake, tmp_path):
    paths, _, staffing = lake
    staffing("2024Q2")
    for name in ("PBJ_Daily_Nurse_Staffing_Q2_2024.csv", "PBJ_Daily_Nurse_Staffing_Q3_2024.csv", "NH_ProviderInfo_Oct2024.csv"):
        put(tmp_path / "drop" / name, "x\n")
    files = offered_files(spark, str(tmp_path / "drop"))
    landed = landed_quarters(spark, paths.bronze)
    assert [r.quarter for r in landed.collect()] == ["2024Q2"]
    todo = assign_files(files, new_quarters(files, landed)).select("name", "quarter").collect()
    assert sorted(tuple(r) for r in todo) == [
        ("NH_ProviderInfo_Oct2024.csv", "2024Q3"), ("PBJ_Daily_Nurse_Staffing_Q3_2024.csv", "2024Q3"),
    ]


def test_nothing_landed_yet(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for folder in ("absent", "empty"):
        landed = landed_quarters(spark, str(tmp_path / folder))
        assert landed.columns == ["quarter"] and landed.count() == 0


def test_served_from_written_tables(spark, lake):
    paths, provider, staffing = lake
    run_silver(spark, staffing("2024Q2"), provider, paths, "2024Q2")
    run_gold(spark, paths, "2024Q2")
    facilities, daily = gold_tables(spark, paths, keep=True)
    assert kpi_cards(facility_filter(facilities)).first().facilities == 2
    assert weekly_trend(daily).count() == 2
    facilities.unpersist()


def test_missing_table_is_none(spark, tmp_path):
    assert read_if_exists(spark, str(tmp_path / "nothing")) is None
