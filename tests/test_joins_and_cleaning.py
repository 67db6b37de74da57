from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from rosterlake.config import DEFAULTS, HOUR_COLUMNS, PROVIDER_FIELDS, STAFFING_COLUMNS
from rosterlake.operators import clean
from rosterlake.operators.joins import fits_broadcast, hot_keys
from rosterlake.sources.csv import MissingColumns, scan_provider, scan_staffing

PROVIDER_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in PROVIDER_FIELDS.values())


def provider_of(spark, *ccns):
    return spark.createDataFrame(
        [(c, "For profit", "Medicare", 100.0, 3.0, 2.0, 40.0, 0.5, 2.0) for c in ccns], PROVIDER_SCHEMA
    )


def write_csv(path, header, *rows):
    path.mkdir()
    text = "\n".join([",".join(header), *[",".join(row) for row in rows]]) + "\n"
    (path / "file.csv").write_bytes(text.encode("latin-1"))
    return str(path)


def test_csv_is_latin1_text_with_leading_zeros(spark, tmp_path):
    row = ["015009", "Château", "Peñasco", "AL", "Doña Ana", "001", "2024Q2", "20240401", "72.0"]
    path = write_csv(tmp_path / "s", STAFFING_COLUMNS, row + ["1.5"] * 23 + [""])
    raw = scan_staffing(spark, path)
    assert {kind for _, kind in raw.dtypes} == {"string"}
    typed = clean.type_staffing(raw).first()
    assert (typed.PROVNUM, typed.PROVNAME, typed.COUNTY_FIPS) == ("015009", "Château", "001")
    assert (typed.MDScensus, typed.WorkDate, typed.Hrs_RNDON) == (72, date(2024, 4, 1), 1.5)
    assert typed.Hrs_MedAide_ctr is None


def test_csv_columns_are_found_by_name(spark, tmp_path):
    """An extra and a moved column, and a file of another header in the same load."""
    moved = [STAFFING_COLUMNS[1], "Extra", STAFFING_COLUMNS[0], *STAFFING_COLUMNS[2:]]
    row = {name: name[:3] for name in STAFFING_COLUMNS} | {"Extra": "?"}
    paths = [
        write_csv(tmp_path / "a", STAFFING_COLUMNS, [row[n] for n in STAFFING_COLUMNS]),
        write_csv(tmp_path / "b", moved, [row[n] for n in moved]),
    ]
    out = scan_staffing(spark, paths)
    assert out.columns == list(STAFFING_COLUMNS)
    assert [tuple(r) for r in out.collect()] == [tuple(row[n] for n in STAFFING_COLUMNS)] * 2
    assert scan_staffing(spark, paths).select("PROVNUM").distinct().count() == 1


def test_csv_without_a_needed_column_is_refused(spark, tmp_path):
    path = write_csv(tmp_path / "s", STAFFING_COLUMNS[:-1], ["x"] * (len(STAFFING_COLUMNS) - 1))
    with pytest.raises(MissingColumns, match=STAFFING_COLUMNS[-1]):
        scan_staffing(spark, path)


def test_bad_values_become_null(spark):
    names = ["WorkDate", "MDScensus", *HOUR_COLUMNS]
    rows = [("2024-04-01", "", *["x"] * 24), (None, "12.7", *["7"] * 24), ("20240401", "NaN", *[""] * 24)]
    out = clean.type_staffing(spark.createDataFrame(rows, names)).collect()
    assert (out[0].WorkDate, out[0].MDScensus, out[0].Hrs_RN) == (None, None, None)
    assert (out[1].MDScensus, out[1].Hrs_RN) == (12, 7.0)
    assert (out[2].WorkDate, out[2].MDScensus) == (date(2024, 4, 1), None)


def test_provider_select_renames_and_types(spark, tmp_path):
    header = ["Provider Name", *PROVIDER_FIELDS]
    path = write_csv(tmp_path / "p", header, ["Näme", "015009", "For profit", "Medicare", "110", "4", "", "x", "0.5", "2"])
    out = clean.select_provider(scan_provider(spark, path))
    assert out.columns == [name for name, _ in PROVIDER_FIELDS.values()]
    assert tuple(out.first()) == ("015009", "For profit", "Medicare", 110.0, 4.0, None, None, 0.5, 2.0)


def test_census_filter_and_counts(staffing_of):
    staffing = staffing_of({"MDScensus": 9}, {"MDScensus": 10}, {"MDScensus": None}, {"MDScensus": 11})
    assert sorted(r.MDScensus for r in clean.enough_census(staffing).collect()) == [10, 11]
    assert tuple(clean.excluded_count(staffing).first()) == (4, 2, 2)


def test_rows_are_conserved(spark, staffing_of):
    staffing = staffing_of(*[
        {"PROVNUM": p, "MDScensus": c} for p in ("000001", "000002", None) for c in (5, 20, 30)
    ])
    joined = clean.join_provider(clean.enough_census(staffing), provider_of(spark, "000001", "000009"))
    counts = clean.excluded_count(staffing).first()
    assert counts.excluded_rows + clean.matched(joined).count() + clean.unmatched(joined).count() == 9
    assert clean.unmatched(joined).count() == 4


def test_duplicate_providers_are_reported_and_multiply(spark, staffing_of):
    provider = provider_of(spark, "000001", "000001", "000002")
    assert [tuple(r) for r in clean.duplicate_providers(provider).collect()] == [("000001", 2)]
    joined = clean.join_provider(staffing_of({"PROVNUM": "000001"}), provider)
    assert joined.count() == 2


def test_salted_join_equals_broadcast_join_with_a_hot_key(spark, staffing_of):
    start = date(2024, 1, 1)
    rows = [{"PROVNUM": "000001", "WorkDate": start + timedelta(days=i), "MDScensus": i} for i in range(300)]
    rows += [{"PROVNUM": f"{i:06d}", "WorkDate": start} for i in range(2, 200)]
    rows += [{"PROVNUM": None, "WorkDate": start}] * 100
    staffing, provider = staffing_of(*rows), provider_of(spark, *[f"{i:06d}" for i in range(1, 150)])
    small = clean.join_provider(staffing, provider, small=True)
    large = clean.join_provider(staffing, provider, small=False, settings=replace(DEFAULTS, hot_share=0.02))
    assert small.columns == large.columns
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0
    assert large.count() == len(rows)


def test_hot_keys_are_split_by_their_share(spark):
    keys = spark.range(900).selectExpr("CASE WHEN id < 300 THEN 'hot' WHEN id < 310 THEN NULL ELSE cast(id AS string) END AS k")
    settings = replace(DEFAULTS, hot_share=0.01)
    assert [tuple(r) for r in hot_keys(keys, "k", settings).collect()] == [("hot", 34)]
    assert hot_keys(keys.limit(0), "k", settings).count() == 0


def test_no_shuffle_partition_holds_a_hot_key_whole(spark, staffing_of):
    start = date(2024, 1, 1)
    staffing = staffing_of(*[
        {"PROVNUM": "000001", "WorkDate": start + timedelta(days=i), "MDScensus": 20} for i in range(640)
    ])
    parts = staffing.select(F.pmod(F.xxhash64("WorkDate", "MDScensus"), F.lit(64)).alias("s")).groupBy("s").count()
    assert parts.count() > 60 and parts.agg(F.max("count")).first()[0] < 640 / 64 * 3


def test_broadcast_needs_both_bounds(spark):
    provider = provider_of(spark, *[f"{i:06d}" for i in range(50)])
    assert fits_broadcast(provider)
    assert not fits_broadcast(provider, replace(DEFAULTS, broadcast_max_rows=49))
    assert not fits_broadcast(provider, replace(DEFAULTS, broadcast_max_bytes=1000))
    assert fits_broadcast(provider.filter("CCN = 'none'"))


def test_schema_contract(staffing_of):
    staffing = staffing_of({})
    assert clean.require_columns(staffing, STAFFING_COLUMNS) is staffing
    with pytest.raises(clean.SchemaMismatch, match="extra"):
        clean.require_columns(staffing.withColumn("extra", F.lit(1)), STAFFING_COLUMNS)
    with pytest.raises(clean.SchemaMismatch, match="CITY"):
        clean.require_columns(staffing.drop("CITY"), STAFFING_COLUMNS)


def test_coverage(spark, staffing_of):
    staffing = staffing_of(*[{"PROVNUM": p} for p in ("a", "a", "b", "c", None)])
    provider = provider_of(spark, "a", "a", "z")
    assert tuple(clean.join_coverage(staffing, provider).first()) == (3, 1, 2, 33.3)
    assert [r[0] for r in clean.unmatched_ids(staffing, provider, 1).collect()] == ["b"]
    assert [r[0] for r in clean.unmatched_ids(staffing, provider, None).collect()] == ["b", "c"]
