"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``python bench.py all`` times every registered query, ``python bench.py name ...`` some. Each result is written to
Spark's noop sink, so all rows and columns are computed and none travels to the driver. ``queries`` start from the
driver's tables every time; ``stored`` are the served and profiling ones again, on bronze, Silver and Gold written
once before (``stored_write``), as a dashboard would read them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from parity.registry import BUILDERS, QUERIES
from parity.tables import StoredTables
from rosterlake.session import build_session


HEADLINE = (
    # sources, typing, joins
    "scan_staffing", "typed_staffing", "assign_files", "join_provider", "join_provider_salted",
    "join_coverage", "silver",
    # Gold
    "daily_ratios", "staffing_metrics", "facility_summary",
    # served
    "kpi_cards", "q1_scatter", "contract_by_state", "cna_by_state", "cna_by_ownership", "weekly_trend",
    "drill_down", "worst_facilities", "chronic_by_state", "filter_options",
    # profiling
    "identity_profile", "duplicate_keys", "missing_report", "zero_report", "describe_stats",
    "census_histogram", "hours_by_type", "tier_profile", "chronic_offenders", "facility_means",
    # merges and loading
    "merge_insert_only", "merge_upsert", "upsert_table", "validate_silver", "incremental_load",
)


STORED = HEADLINE[HEADLINE.index("daily_ratios"):HEADLINE.index("merge_insert_only")]


def timed(frame_of) -> float:
    start = time.perf_counter()
    frame_of().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def run(spark, name: str, sf_dir: str) -> float:
    return timed(lambda: QUERIES[name](spark, sf_dir))


def run_stored(spark, names: list[str], sf_dir: str) -> tuple[float, dict[str, float]]:
    start = time.perf_counter()
    tables = StoredTables(spark, sf_dir)
    written = round(time.perf_counter() - start, 3)
    return written, {name: timed(lambda n=name: BUILDERS[n](tables)) for name in names}


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
        spark__checkpoint__dir=os.environ.get("BENCH_SHARED_DIR", "/tmp/checkpoints"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "facility_summary", sf_dir)  # warm up the JVM
    chosen = list(QUERIES) if names == ["all"] else names or HEADLINE
    times = {name: run(spark, name, sf_dir) for name in chosen}
    served = [name for name in chosen if name in STORED]
    written, stored = run_stored(spark, served, sf_dir) if served else (0.0, {})
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "stored": stored,
        "stored_write": written,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main(sys.argv[1:])
