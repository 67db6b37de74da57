"""Steps whose tasks must not grow with the table."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parity import registry, tables
from parity.registry import QUERIES, land_staffing
from rosterlake.config import HOUR_COLUMNS
from rosterlake.operators import clean
from rosterlake.sinks import tables as sinks
from rosterlake.sources import csv as text

SF = "/root/testdata/sf0.001"


def test_a_task_folds_as_many_order_lines_however_many_there_are(spark, monkeypatch):
    monkeypatch.setattr(tables, "LINES_PER_TASK", 200, raising=False)
    days = tables.Tables(spark, SF)._facility_days(None).select("l_suppkey", F.trunc("WorkDate", "quarter").alias("q"), F.spark_partition_id().alias("part"))
    held = [row["n"] for row in days.groupBy("part").agg(F.count("*").alias("n")).collect()]
    assert len(held) >= 10 and max(held) <= 3 * 200  # 6,000 lines
    places = days.groupBy("l_suppkey", "q").agg(F.countDistinct("part").alias("n")).agg(F.max("n")).first()[0]
    assert places == 1  # so that facilities' quarters are whole before they are shuffled


@pytest.mark.parametrize("delivery", [None, "F", "O"])
def test_a_task_of_the_stored_gold_tables_and_of_an_upsert_holds_as_many_days_however_many_there_are(spark, monkeypatch, delivery):
    monkeypatch.setattr(tables, "LINES_PER_TASK", 200, raising=False)
    days = tables.Tables(spark, SF).silver(delivery).select("PROVNUM", "quarter", F.spark_partition_id().alias("part"))
    held = [row["n"] for row in days.groupBy("part").agg(F.count("*").alias("n")).collect()]
    assert len(held) >= 10 and max(held) <= 3 * 200
    places = days.groupBy("PROVNUM", "quarter").agg(F.countDistinct("part").alias("n")).agg(F.max("n")).first()[0]
    assert places == 1  # the provider join moves no day: a facility's quarter still sends one row to the summary


def test_typing_makes_no_method_too_long_to_compile(spark):
    typed = QUERIES["typed_staffing"](spark, SF)
    typed.collect()  # the plan that ran is the one to look at
    code = spark._jvm.PythonSQLUtils.explainString(typed._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:\s*(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_landed_text_is_written_where_it_is_made_and_packed(spark, monkeypatch):
    monkeypatch.setattr(tables, "LINES_PER_FILE", 1000, raising=False)
    bronze = land_staffing(tables.Tables(spark, SF))
    folders = [folder for folder in Path(bronze.removeprefix("file:")).glob("quarter=*")]
    files = [file for folder in folders for file in folder.glob("part-*")]
    assert files and all(file.suffix == ".gz" for file in files)
    assert len(files) <= len(folders) + 7  # ranges of quarters, seven of them: no task writes to every folder


def test_rows_of_quarters_held_or_lacking_as_wholes_go_through_no_join(spark, tmp_path, monkeypatch):
    joined = []
    compare = sinks.rows_to_insert

    def watched(target, source, *more):
        joined.extend(sorted({row[0] for row in source.select("work_quarter").collect()}))
        return compare(target, source, *more)

    monkeypatch.setattr(sinks, "rows_to_insert", watched)
    path = str(tmp_path / "days")

    def load(*rows):
        source = spark.createDataFrame(rows, "k string, day string, v int").withColumn("day", F.to_date("day"))
        sinks.insert_only(spark, source, path, ("k", "day"), ["v"], range_column="day")

    first = [("a", "2024-01-01", 1), ("a", "2024-04-01", 1), ("b", "2024-04-02", 1), ("a", "2024-07-01", 1)]
    load(*first)
    load(*first)  # all held
    load(("c", "2024-01-01", 2), ("a", "2024-10-01", 2))  # held quarter, other keys; new quarter
    assert joined == []
    load(("a", "2024-04-01", 3), ("z", "2024-04-01", 3), ("a", "2024-07-01", 3), ("y", "2024-10-01", 3), ("n", None, 3))
    load(("n", None, 3))
    assert joined == ["d2024Q2"]
    held = sorted((str(row["k"]), str(row["day"]), row["v"]) for row in spark.read.parquet(path).collect())
    more = [("c", "2024-01-01", 2), ("a", "2024-10-01", 2), ("z", "2024-04-01", 3), ("y", "2024-10-01", 3), ("n", "None", 3), ("n", "None", 3)]
    assert held == sorted(first + more)


def test_hours_are_typed_outside_of_arrays_as_in_them(spark):
    given = ["12.50000000", " 7 ", "1e3", "-0.25", "inf", "-Infinity", "NaN", "nan", "1d", "", "n/a", "1,5", None]
    raw = spark.createDataFrame([(v,) for v in given], "h string").select("h", *(F.col("h").alias(n) for n in HOUR_COLUMNS))
    typed = clean.type_staffing(raw.withColumns({"MDScensus": F.lit("5"), "WorkDate": F.lit("20240101")}))
    same = F.col("Hrs_RN").eqNullSafe(F.transform(F.array("h"), lambda value: value.try_cast("double"))[0])
    assert typed.filter(same).count() == len(given)
    plan = typed.select("Hrs_RN")._jdf.queryExecution().optimizedPlan().toString()
    assert "coalesce(try_cast(" in plan  # the array, which costs four times as much, is for text without a value


def test_hours_are_written_as_decimals_write_them(spark):
    given = [0.0, -0.0, 1 / 64, -2.5, 7.0, 0.1, 1 / 3, 2.9999999999999996, 0.000000015, 9999999.99999999, 1e7 - 1 / 64, 1e7, -12345678.125, 9e9, None]
    rows = spark.createDataFrame([(v,) for v in given], "h double")
    both = rows.select(tables.hours_text("h").alias("new"), F.col("h").cast("decimal(18,8)").cast("string").alias("old")).collect()
    assert [row["new"] for row in both] == [row["old"] for row in both]


def test_each_large_packed_file_is_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text, "_SMALL_FILE", 10)
    for i in range(9):
        spark.createDataFrame([(str(i), "x")], "A string, B string").coalesce(1).write.option("header", True).option("compression", "gzip").csv(str(tmp_path / f"f{i}"))
    rows = text.scan_by_name(spark, str(tmp_path / "f*"), ["A"], file_column="file")
    tasks = {row["A"]: row["task"] for row in rows.select("A", F.spark_partition_id().alias("task")).collect()}
    assert sorted(tasks) == [str(i) for i in range(9)]
    assert len(set(tasks.values())) == 9  # Spark alone packs three in a task, and leaves one of four cores idle
    assert rows.select("file").distinct().count() == 9


def test_the_books_are_closed_over_text_parsed_once(spark, monkeypatch):
    inputs = []
    monkeypatch.setattr(registry.silver_plan, "run_silver", lambda *a, **k: None)
    monkeypatch.setattr(registry, "load_new_days", lambda *a, **k: None)
    monkeypatch.setattr(registry.layers, "read_table", lambda spark, path: tables.Tables(spark, SF).silver())
    monkeypatch.setattr(registry.audit, "read_audit", lambda spark, path: tables.Tables(spark, SF).silver())
    monkeypatch.setattr(registry.audit, "reconciled", lambda *rows: inputs.extend(rows) or rows[0])
    registry.audit_reconciled(tables.Tables(spark, SF))
    assert len(inputs) == 4 and inputs[0].count() > inputs[1].count() > 0
    assert all("csv" not in rows._jdf.queryExecution().executedPlan().toString().lower() for rows in inputs)
