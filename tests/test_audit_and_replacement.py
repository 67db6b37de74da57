"""The audit log under every way of loading, partitions replaced with stops in between, files landed, providers made unique."""

import hashlib
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rosterlake.config import PROVIDER_FIELDS, STAFFING_COLUMNS
from rosterlake.operators import clean, distinct, profile
from rosterlake.operators.ranks import rank_correlations
from rosterlake.plans.silver import run_silver
from rosterlake.sinks import audit, landing, replace, tables
from rosterlake.sources.csv import MissingColumns, header_census, scan_provider, scan_staffing, staffing_files
from rosterlake.sources.tables import read_table
from rosterlake.streaming.incremental import load_new_days
from test_pipeline import lake, put  # noqa: F401

SCHEMA = "k string, quarter string, v int"


def contents(spark, path):
    return sorted(tuple(r) for r in read_table(spark, path).select("k", "quarter", "v").collect())


def audited(spark, paths):
    return Counter(tuple(r) for r in audit.read_audit(spark, paths.audit).select("PROVNUM", "WorkDate").collect())


# --- replacing partitions -------------------------------------------------------------

class Stop(Exception):
    pass


@pytest.mark.parametrize("stop_after", [0, 1, 2, 3])
def test_upsert_stopped_between_folders_is_finished_by_the_next_run(spark, tmp_path, monkeypatch, stop_after):
    """Three quarters are replaced; the run stops after so many moves (0: before the marker). No row of any is lost."""
    path = str(tmp_path / "table")
    old = spark.createDataFrame([(k, q, 1) for q in ("q1", "q2", "q3") for k in "abc"], SCHEMA)
    new = spark.createDataFrame([(k, q, 2) for q in ("q1", "q2", "q3") for k in "cd"], SCHEMA)
    tables.upsert(spark, old, path, ("k", "quarter"), "quarter")
    moves, real = [], replace._move

    def move(files, source, target):
        if len(moves) == stop_after:
            raise Stop
        moves.append(target.getName())
        real(files, source, target)

    monkeypatch.setattr(replace, "_move", move)
    with pytest.raises(Stop):
        tables.upsert(spark, new, path, ("k", "quarter"), "quarter")
    monkeypatch.setattr(replace, "_move", real)
    before = sorted([(k, q, 1) for q in ("q1", "q2", "q3") for k in "abc"])
    merged = sorted([(k, q, 1) for q in ("q1", "q2", "q3") for k in "ab"] + [(k, q, 2) for q in ("q1", "q2", "q3") for k in "cd"])
    if stop_after == 0:
        assert contents(spark, path) == before
    assert replace.finish_replacements(spark, path) == (stop_after > 0)
    assert contents(spark, path) == (merged if stop_after else before)
    assert replace.finish_replacements(spark, path) == 0
    tables.upsert(spark, new, path, ("k", "quarter"), "quarter")
    assert contents(spark, path) == merged


def test_stop_after_the_old_folder_is_gone(spark, tmp_path, monkeypatch):
    """The worst moment: a partition's old folder is deleted, its new one not yet in place. A later upsert of another quarter heals it."""
    path = str(tmp_path / "table")
    tables.upsert(spark, spark.createDataFrame([("a", "q1", 1), ("b", "q2", 1)], SCHEMA), path, ("k", "quarter"), "quarter")
    real = replace._move
    monkeypatch.setattr(replace, "_move", lambda files, source, target: real(files, source, target) if "=" not in target.getName() else (_ for _ in ()).throw(Stop()))
    with pytest.raises(Stop):
        tables.upsert(spark, spark.createDataFrame([("c", "q1", 2)], SCHEMA), path, ("k", "quarter"), "quarter")
    monkeypatch.setattr(replace, "_move", real)
    assert contents(spark, path) == [("b", "q2", 1)]
    tables.upsert(spark, spark.createDataFrame([("d", "q2", 3)], SCHEMA), path, ("k", "quarter"), "quarter")
    assert contents(spark, path) == [("a", "q1", 1), ("b", "q2", 1), ("c", "q1", 2), ("d", "q2", 3)]


def test_null_partitions_and_removal(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([("a", None, 1), ("b", "q 1/2", 1), ("c", "q3", 1)], SCHEMA)
    replace.replace_partitions(spark, rows, path, ["quarter"])
    replace.replace_partitions(spark, rows.filter("quarter IS NULL").withColumn("v", F.lit(9)), path, ["quarter"], ["quarter=q3", "quarter=absent"])
    assert sorted(str(tuple(r)) for r in read_table(spark, path).select("k", "quarter", "v").collect()) == [
        "('a', None, 9)", "('b', 'q 1/2', 1)"]


# --- the audit log --------------------------------------------------------------------------

def test_both_writers_share_one_log(spark, lake, tmp_path):  # noqa: F811
    """Batch, batch again, stream, stream with a new checkpoint, and files in another grouping: every unmatched row once."""
    paths, provider, staffing = lake
    first, second = staffing("2024Q2"), staffing("2024Q2", "PBJ_Daily_Nurse_Staffing b+1%.csv", facilities=("777777",), n=4)
    third = staffing("2024Q3", facilities=("888888", "015009"), n=3)
    providers = clean.select_provider(scan_provider(spark, provider))
    wanted = Counter()
    for file in (first, second, third):
        for line in open(file, encoding="latin-1").read().splitlines()[1:]:
            if line.startswith(("999999", "777777", "888888")):
                wanted[line.split(",")[0]] += 1

    def held():
        return Counter(r.PROVNUM for r in audit.read_audit(spark, paths.audit).collect())

    def stream(checkpoint, files_per_batch):
        load_new_days(spark, paths.bronze, providers, paths.silver, str(tmp_path / checkpoint), paths.audit, files_per_batch=files_per_batch)

    report = run_silver(spark, first, provider, paths, "2024Q2")
    assert (report.unmatched_rows, report.stamp_mismatches) == (10, 0) and held() == {"999999": 10}
    run_silver(spark, [first, second], provider, paths, "2024Q2")
    assert held() == {"999999": 10, "777777": 4}
    stream("one", 1)
    assert held() == wanted
    stream("two", 1000)  # all files in one batch, under a new checkpoint
    assert held() == wanted
    run_silver(spark, second, provider, paths, "2024Q2")
    assert held() == wanted
    assert audit.read_audit(spark, paths.audit).columns == [*STAFFING_COLUMNS, *[name for name, _ in PROVIDER_FIELDS.values()]]
    typed = clean.type_staffing(scan_staffing(spark, paths.bronze))
    books = audit.reconciled(typed, clean.enough_census(typed), read_table(spark, paths.silver), audit.read_audit(spark, paths.audit)).collect()
    assert len(books) == 2 and all(r.balanced for r in books)
    assert sum(r.audit_rows for r in books) == sum(wanted.values())


def test_a_repeat_without_unmatched_rows_empties_its_part(spark, lake):  # noqa: F811
    paths, provider, staffing = lake
    file, other = staffing("2024Q2"), staffing("2024Q2", "PBJ_Daily_Nurse_Staffing_b.csv", facilities=("777777",), n=2)
    run_silver(spark, [file, other], provider, paths, "2024Q2")
    assert set(audited(spark, paths)) and len(audit.read_audit(spark, paths.audit).collect()) == 12
    put(Path(provider).parent / "provider2.csv", open(provider, encoding="latin-1").read() + "999999,For profit,Medicare,120,3,2,40,0.5,2\n")
    run_silver(spark, file, provider.replace("provider.csv", "provider2.csv"), paths, "2024Q2")
    assert Counter(r.PROVNUM for r in audit.read_audit(spark, paths.audit).collect()) == {"777777": 2}


def test_delivery_key_is_of_the_set_of_files():
    assert audit.delivery_key(["b", "a", "b"]) == audit.delivery_key(["a", "b"]) != audit.delivery_key(["a"])


def test_counts_of_an_empty_load(spark, lake, tmp_path):  # noqa: F811
    paths, provider, _ = lake
    empty = put(tmp_path / "empty.csv", ",".join(STAFFING_COLUMNS) + "\n")
    report = run_silver(spark, empty, provider, paths, "2024Q2")
    assert (report.raw_rows, report.excluded_rows, report.matched_rows, report.unmatched_rows) == (0, 0, 0, 0)


def test_stamp_mismatches_are_counted(spark, lake):  # noqa: F811
    paths, provider, staffing = lake
    report = run_silver(spark, staffing("2024Q2"), provider, paths, "2024Q3")
    assert report.stamp_mismatches == report.raw_rows == 30


# --- CSV headers --------------------------------------------------------------------------------

def test_header_census_of_many_files(spark, tmp_path):
    """2,000 files of three headers, some empty, one with a space in its name: a job, and no read of whole files by the driver."""
    header = ",".join(STAFFING_COLUMNS)
    kinds = [header, ",".join([*STAFFING_COLUMNS[1:], "Extra", STAFFING_COLUMNS[0]]), header + ',"é, quoted"']
    for i in range(2000):
        text = "" if i % 100 == 7 else kinds[i % 3] + "\n" + "1,2\n" * (i % 5)
        (tmp_path / f"part {i}+%.csv").write_bytes(text.encode("latin-1"))
    start = time.perf_counter()
    found = header_census(spark, str(tmp_path))
    assert time.perf_counter() - start < 30
    assert len(found) == 3 and sum(map(len, found.values())) == 1980
    assert sorted(len(h) for h in found) == [33, 34, 34] and any(h[-1] == "é, quoted" for h in found)
    assert set().union(*found.values()) <= set(staffing_files(spark, str(tmp_path)))


def test_header_of_a_large_file_and_missing_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(STAFFING_COLUMNS) + "\n" + ("x," * 32 + "y\n") * 120_000)
    assert list(header_census(spark, str(tmp_path))) == [STAFFING_COLUMNS]
    rows = scan_staffing(spark, str(tmp_path), "file")
    assert rows.count() == 120_000 and [r.file for r in rows.select("file").distinct().collect()] == staffing_files(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text("PROVNUM,STATE\n1,2\n")
    with pytest.raises(MissingColumns, match="b.csv"):
        scan_staffing(spark, str(tmp_path))


# --- landing -----------------------------------------------------------------------------------

def test_files_land_byte_for_byte(spark, tmp_path):
    drop, bronze = tmp_path / "drop", str(tmp_path / "bronze")
    drop.mkdir()
    given = {"a b.csv": b"\xff\x00\r\n", "empty.csv": b"", "big.bin": bytes(range(256)) * 50_000}
    for name, content in given.items():
        (drop / name).write_bytes(content)
    assigned = spark.createDataFrame(
        [(f"file:{drop}/{name}", name, q) for name in given for q in ("2024Q2", "2024Q3")], "id string, name string, quarter string"
    )
    for _ in range(2):  # a second run puts the same in the same place
        got = {(r.quarter, r.name): (r.length, r.sha256) for r in landing.land_files(spark, assigned, bronze).collect()}
        assert got == {(q, n): (len(c), hashlib.sha256(c).hexdigest()) for n, c in given.items() for q in ("2024Q2", "2024Q3")}
    for q in ("2024Q2", "2024Q3"):
        folder = tmp_path / "bronze" / f"quarter={q}"
        assert {f.name: f.read_bytes() for f in folder.iterdir()} == given
    assert landing.land_files(spark, assigned.limit(0), bronze).count() == 0


# --- providers, ranks, empty profiles ----------------------------------------------------------------

def test_one_row_for_each_provider(spark):
    rows = [("1", "x", 1.0), ("1", "y", None), ("1", "a", 5.0), ("2", None, None), ("2", None, None), ("3", "z", 1.0), (None, "n", 1.0)]
    provider = spark.createDataFrame(rows, "CCN string, owner string, beds double")
    kept = clean.unique_providers(provider)
    assert kept.columns == provider.columns
    assert sorted(tuple(r) for r in kept.collect()) == [("1", "x", 1.0), ("2", None, None), ("3", "z", 1.0)]
    assert sorted(tuple(r) for r in kept.collect()) == sorted(tuple(r) for r in clean.unique_providers(provider.orderBy(F.desc("owner"))).collect())
    conflicts = {r.CCN: (r.rows, r.variants, r.conflicts) for r in clean.provider_conflicts(provider).collect()}
    assert conflicts == {"1": (3, 3, "owner,beds"), "2": (2, 1, "")}


def test_rank_correlations_match_pandas(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"g": rng.integers(0, 3, 600).astype(str), "a": np.round(rng.normal(size=600), 1), "b": rng.integers(0, 4, 600).astype(float)})
    frame["c"] = np.where(rng.random(600) < 0.2, np.nan, frame["a"] + rng.normal(size=600))
    frame["d"] = 7.0
    got = {(r.g, r.measure, r.quality): (r.facilities, r.rank_correlation) for r in
           rank_correlations(spark.createDataFrame(frame), ("g",), ("a", "c"), ("b", "d")).collect()}
    assert len(got) == 12
    for (g, x, y), (n, value) in got.items():
        part = frame[frame.g == g][[x, y]].dropna()
        assert n == len(part)
        if y == "d":
            assert value is None
        else:
            ranks = part.rank()
            assert value == pytest.approx(ranks[x].corr(ranks[y]), abs=1e-6)


def test_profiles_of_an_empty_table(staffing_of):
    empty = staffing_of({}).limit(0)
    zeros = profile.zero_report(empty).collect()
    assert len(zeros) == 24 and all((r.zero_count, r.zero_pct, r.mean_nonzero) == (0, None, 0.0) for r in zeros)
    assert [tuple(r)[1:] for r in profile.outlier_check(empty).collect()] == [(None, 0)] * 3
    assert [r.avg_hours for r in profile.hours_by_type(empty).collect()] == [None] * 7
    assert [(r["count"], r["mean"], r.p50) for r in profile.describe_stats(empty).collect()] == [(0, None, None)] * 4
    listed = clean.contract_report(empty.drop("STATE").withColumn("more", F.lit(1)), STAFFING_COLUMNS).collect()
    assert Counter((r.status, r.filled_rows) for r in listed) == {("ok", 0): 32, ("missing", None): 1, ("unexpected", 0): 1}


def test_distinct_counts_from_bitmaps(spark, tmp_path):
    """Three loads, one of them again with other rows: as if all had been counted together."""
    rows = [("q1", f"v{i}") for i in range(500)] + [("q2", f"v{i}") for i in range(300, 900)] + [("q2", None), (None, "w")]
    frame = spark.createDataFrame(rows, "quarter string, v string").repartition(3)
    for part in (frame.filter("quarter = 'q1'"), frame.filter("quarter = 'q2'"), frame.filter("quarter IS NULL")):
        distinct.add_load(spark, part, str(tmp_path), "quarter", ("v", "quarter"))

    def counted(where="true"):
        return {r.kind: r.distinct for r in distinct.distinct_counts(distinct.read_bitmaps(spark, str(tmp_path)).filter(where)).collect()}

    assert counted() == {"v": 901, "quarter": 2} and counted("quarter = 'q2'") == {"v": 600, "quarter": 1}
    distinct.add_load(spark, frame.filter("quarter = 'q2' AND v < 'v5'"), str(tmp_path), "quarter", ("v", "quarter"))
    assert counted()["v"] == len({v for q, v in rows if v and (q != "q2" or v < "v5")})
    ids = spark.read.parquet(str(tmp_path / "dictionary"))
    assert ids.count() == ids.select("id").distinct().count() == ids.select("kind", "value").distinct().count() == 903
