from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from rosterlake.operators import merge
from rosterlake.session import scratch_dir
from rosterlake.sinks import checks, tables as sinks
from rosterlake.sources.tables import landing_path, read_if_exists, read_table

SCHEMA = "PROVNUM string, WorkDate date, quarter string, STATE string, v int"
KEYS = ("PROVNUM", "WorkDate")
D1, D2, D3 = date(2024, 4, 1), date(2024, 4, 2), date(2024, 7, 1)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select("PROVNUM", "WorkDate", "quarter", "STATE", "v").collect()),
                  key=str)


def files_of(spark, path, partition):
    return {f for f in read_table(spark, path).inputFiles() if partition in f}


def test_insert_only_keeps_old_rows_and_repeats_duplicates(spark):
    target = spark.createDataFrame([("a", D1, "q", "AL", 1)], SCHEMA)
    source = spark.createDataFrame(
        [("a", D1, "q", "AL", 9), ("a", D2, "q", "AL", 2), ("a", D2, "q", "AL", 2), ("b", None, "q", "AL", 3)], SCHEMA
    )
    out = merge.merge_insert_only(target, source, KEYS)
    assert sorted(r.v for r in out.collect()) == [1, 2, 2, 3]
    # a NULL key never matches, unless asked to
    again = merge.merge_insert_only(out, source, KEYS)
    assert again.count() == 5
    assert merge.merge_insert_only(out, source, KEYS, null_safe=True).count() == 4


def test_upsert_replaces_and_adds(spark):
    target = spark.createDataFrame([("a", D1, "q1", "AL", 1), ("b", D1, "q1", "AL", 2)], SCHEMA)
    source = spark.createDataFrame([("a", D1, "q1", "GA", 9), ("c", D1, "q1", "AL", 3)], SCHEMA)
    out = merge.merge_upsert(target, source, ("PROVNUM", "quarter"))
    assert sorted((r.PROVNUM, r.STATE, r.v) for r in out.collect()) == [("a", "GA", 9), ("b", "AL", 2), ("c", "AL", 3)]


def test_insert_only_table_rerun_adds_nothing(spark):
    path = scratch_dir(spark, "insert")
    first = spark.createDataFrame([("a", D1, "2024Q2", "AL", 1), ("b", D1, "2024Q2", None, 2)], SCHEMA)
    second = spark.createDataFrame([("a", D1, "2024Q2", "AL", 7), ("a", D3, "2024Q3", "AL", 3)], SCHEMA)
    for batch in (first, second, second, first):
        sinks.insert_only(spark, batch, path, KEYS, ("quarter", "STATE"), range_column="WorkDate")
    assert rows_of(read_table(spark, path)) == sorted(
        [("a", D1, "2024Q2", "AL", 1), ("b", D1, "2024Q2", None, 2), ("a", D3, "2024Q3", "AL", 3)], key=str
    )


def test_insert_only_table_without_dates_or_rows(spark):
    path = scratch_dir(spark, "insert")
    base = spark.createDataFrame([("a", D1, "q1", "AL", 1)], SCHEMA)
    sinks.insert_only(spark, base, path, KEYS, ("quarter", "STATE"), range_column="WorkDate")
    undated = spark.createDataFrame([("a", None, "q1", "AL", 2)], SCHEMA)
    sinks.insert_only(spark, undated, path, KEYS, ("quarter", "STATE"), range_column="WorkDate")
    sinks.insert_only(spark, base.limit(0), path, KEYS, ("quarter", "STATE"), range_column="WorkDate")
    assert read_table(spark, path).count() == 2


def test_upsert_table_moves_rows_and_leaves_other_quarters_alone(spark):
    path, keys = scratch_dir(spark, "upsert"), ("PROVNUM", "quarter")
    sinks.upsert(spark, spark.createDataFrame(
        [("a", D1, "q1", "AL", 1), ("b", D1, "q1", "AL", 2), ("a", D3, "q2", "AL", 5)], SCHEMA), path, keys, "quarter")
    change = spark.createDataFrame([("a", D1, "q1", "GA", 9), ("n", D1, "q3", "AL", 8)], SCHEMA)
    before = files_of(spark, path, "quarter=q2")
    for _ in range(2):
        sinks.upsert(spark, change, path, keys, "quarter")
        assert rows_of(read_table(spark, path)) == sorted([
            ("a", D1, "q1", "GA", 9), ("b", D1, "q1", "AL", 2), ("a", D3, "q2", "AL", 5), ("n", D1, "q3", "AL", 8),
        ], key=str)
    assert files_of(spark, path, "quarter=q2") == before


def test_upsert_refuses_two_rows_for_one_target_row(spark):
    path, keys = scratch_dir(spark, "upsert"), ("PROVNUM", "quarter")
    sinks.upsert(spark, spark.createDataFrame([("a", D1, "q1", "AL", 1)], SCHEMA), path, keys, "quarter")
    renamed = spark.createDataFrame([("a", D1, "q1", "AL", 1), ("a", D1, "q1", "GA", 2)], SCHEMA)
    with pytest.raises(merge.AmbiguousMerge):
        sinks.upsert(spark, renamed, path, keys, "quarter")
    with pytest.raises(ValueError, match="part of the key"):
        sinks.upsert(spark, renamed, path, keys, "STATE")
    assert read_table(spark, path).count() == 1


def test_first_upsert_refuses_an_ambiguous_source_too(spark):
    path = scratch_dir(spark, "upsert")
    renamed = spark.createDataFrame([("a", D1, "q1", "AL", 1), ("a", D1, "q1", "GA", 2)], SCHEMA)
    with pytest.raises(merge.AmbiguousMerge):
        sinks.upsert(spark, renamed, path, ("PROVNUM", "quarter"), "quarter")
    assert read_if_exists(spark, path) is None


def test_scratch_needs_the_setting():
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(bare, "x")


def test_null_partition_value_upserts(spark):
    path, keys = scratch_dir(spark, "upsert"), ("PROVNUM", "quarter")
    sinks.upsert(spark, spark.createDataFrame([("a", D1, None, "AL", 1), ("b", D1, "q1", "AL", 2)], SCHEMA), path, keys, "quarter")
    sinks.upsert(spark, spark.createDataFrame([("c", D1, None, "AL", 3)], SCHEMA), path, keys, "quarter")
    assert sorted(r.v for r in read_table(spark, path).collect()) == [1, 2, 3]


def test_audit_log_is_written_only_with_rows(spark):
    path = scratch_dir(spark, "audit")
    rows = spark.createDataFrame([("a", D1, "q", "AL", 1)], SCHEMA)
    assert not sinks.append_if_any(rows.limit(0), path)
    assert read_if_exists(spark, path) is None
    assert sinks.append_if_any(rows, path) and sinks.append_if_any(rows, path)
    assert read_table(spark, path).count() == 2


def test_create_table_splits_a_large_partition(spark):
    """A state with nearly all rows is written by several tasks."""
    path = scratch_dir(spark, "skewed")
    rows = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 100 == 0, "GA").otherwise("AL").alias("STATE"), F.sha2(F.col("id").cast("string"), 256).alias("text")
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        sinks.create_table(rows, path, ["STATE"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    written = read_table(spark, path)
    assert written.count() == 400_000
    assert len(files_of(spark, path, "STATE=AL")) > 3
    assert tuple(checks.table_size(spark, path).first()) == (400_000, 2)


def test_csv_export_keeps_order_and_text(spark):
    path = scratch_dir(spark, "csv")
    sinks.export_csv(spark.createDataFrame([(2, "é"), (1, "a")], "k int, t string").orderBy("k"), path)
    back = spark.read.option("header", True).csv(path)
    assert [tuple(r) for r in back.orderBy("k").collect()] == [("1", "a"), ("2", "é")]


def test_csv_export_doubles_quotes(spark):
    path = scratch_dir(spark, "csv")
    sinks.export_csv(spark.createDataFrame([('St "A" Home, x',)], "t string"), path)
    assert 'St ""A"" Home, x' in "".join(r.value for r in spark.read.text(path).collect())


def test_landing_path():
    assert landing_path("/b/", "2024Q2", "f.csv") == "/b/quarter=2024Q2/f.csv"
