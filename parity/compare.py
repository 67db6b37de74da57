"""Run registered queries and their SQL side by side.

    python -m parity.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

from parity.oracle import ORACLE
from parity.registry import QUERIES
from rosterlake.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


_TYPES = {
    "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT",
    "date": "DATE", "boolean": "BOOLEAN",
}


def differences(spark, con, name: str, sf_dir: str) -> tuple[list[str], int]:
    """What differs, and the number of rows compared. Values must be bit-equal."""
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = Counter(tuple(row) for row in frame.select(*[f"`{c}`" for c in columns]).collect())
    answer = con.sql(ORACLE[name])
    found = []
    if sorted(answer.columns) != columns:
        return [f"columns {columns} != {sorted(answer.columns)}"], sum(got.values())
    kinds = dict(zip(answer.columns, (str(t) for t in answer.types)))
    for column, kind in frame.dtypes:
        if _TYPES.get(kind) != kinds[column]:
            found.append(f"type of {column}: {kind} != {kinds[column]}")
    wanted = Counter(answer.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    if got != wanted:
        extra, missing = list((got - wanted).items())[:2], list((wanted - got).items())[:2]
        found.append(
            f"rows {sum(got.values())} != {sum(wanted.values())}, "
            f"{sum((got - wanted).values())} differ; spark {extra}; sql {missing}"
        )
    return found, sum(got.values())


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(
        "parity", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
        spark__driver__memory="12g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            found, rows = differences(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            found, rows = [f"{type(error).__name__}: {str(error)[:1500]}"], -1
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name:28s} rows={rows} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("     ", line[:1800])
    print(f"{bad} of {len(names or QUERIES)} differ; without SQL: {sorted(set(QUERIES) - set(ORACLE))}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
