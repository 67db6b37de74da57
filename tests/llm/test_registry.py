"""Registered queries: names, and SQL twins where there are any."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from rosterlake.llm.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


#: Queries that SQL cannot express, and the test that holds each against plain code.
BY_BRUTE_FORCE = {
    "op1_token_counts": "test_token_counts.py",
    "op2_language_id": "test_language_id.py",
    "op3_best_fit_packing": "test_packing.py",
    "op7_personal_data": "test_personal_data.py",
    "op8_fingerprints": "test_fingerprints.py",
    "op9_quality_rules": "test_quality.py",
    "op10_near_duplicates": "test_near_duplicates.py",
    "pipeline": "test_corpus_pipeline.py",
}


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


def test_every_query_is_held_by_sql_or_brute_force():
    assert {*QUERIES, "pipeline"} == {*ORACLE, *BY_BRUTE_FORCE} and not {*ORACLE} & {*BY_BRUTE_FORCE}
    assert all((Path(__file__).parent / name).exists() for name in BY_BRUTE_FORCE.values())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    answer = con.sql(ORACLE[name])
    assert sorted(answer.columns) == columns
    wanted = Counter(answer.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == wanted
