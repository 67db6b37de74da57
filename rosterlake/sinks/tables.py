"""Table writers.

Formats are pluggable through ``fmt``; the merges only need a format that appends and
overwrites partitions dynamically, which plain Parquet does. One writer per table at a
time: Parquet has no transactions across partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.functions.calendar import quarter_label
from rosterlake.operators.merge import check_unambiguous, held_share, merge_upsert, rows_to_insert
from rosterlake.session import scratch, staged
from rosterlake.sinks.replace import finish_replacements, replace_partitions
from rosterlake.sources.tables import DAY_QUARTER, read_if_exists


def _by_partition(rows: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Bring rows of one output partition together without letting a large one end up
    in a single task: AQE splits and joins the shuffle blocks to its advisory size."""
    return rows.hint("rebalance", *partitions)


def create_table(
    rows: DataFrame, path: str, partitions: Sequence[str], fmt: str = "parquet"
) -> None:
    """Write a table from scratch, replacing what is there."""
    (
        _by_partition(rows, partitions)
        .write.format(fmt).mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partitions).save(path)
    )


def append_rows(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    rows.write.format(fmt).mode("append").save(path)


def append_if_any(rows: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Append to a log unless there is nothing to log."""
    if rows.isEmpty():
        return False
    append_rows(rows, path, fmt)
    return True


def insert_only(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: tuple[str, ...],
    partitions: Sequence[str],
    range_column: str | None = None,
    null_safe: bool = False,
    fmt: str = "parquet",
) -> None:
    """Add the source rows whose key the table lacks; create the table on first use.

    Safe to run again after a failure: rows that made it are then held. With ``range_column``,
    a date among the keys, the table gets one more partition column, its quarter: equal
    dates share it, so only the source's quarters of the table are listed and read. A delivery of a new
    quarter finds nothing there and is written without being shuffled for the key comparison.
    A NULL date matches nothing, as before.
    """
    target = read_if_exists(spark, path, fmt, derived=True)
    if range_column and (target is None or DAY_QUARTER in target.columns):
        source = source.withColumn(
            DAY_QUARTER, F.concat(F.lit("d"), quarter_label(F.col(range_column)))
        )
        partitions = [DAY_QUARTER, *partitions]
    if target is None:
        create_table(source, path, partitions, fmt)
        return
    fresh = (
        _fresh_by_span(spark, target, source, keys, null_safe) if DAY_QUARTER in target.columns
        else source if target.isEmpty() else rows_to_insert(target, source, keys, null_safe)
    )
    if fresh is not None:
        (
            _by_partition(fresh, partitions)
            .write.format(fmt).mode("append").partitionBy(*partitions).save(path)
        )


def _in_spans(spans: Sequence[str | None]) -> Column:
    found = F.col(DAY_QUARTER).isin([span for span in spans if span is not None])
    return found | F.col(DAY_QUARTER).isNull() if None in spans else found


def _fresh_by_span(
    spark: SparkSession, target: DataFrame, source: DataFrame, keys: tuple[str, ...], null_safe: bool
) -> DataFrame | None:
    """The source rows whose key the table lacks, None if there are none.

    The keys are compared first, alone. Quarters of which the table holds no row, or each row, are then known
    to be inserted or left as wholes; only where some rows are held do the rows themselves go through a join.
    """
    with scratch(spark, "insert") as folder:
        narrow = staged(spark, source.select(DAY_QUARTER, *keys), "keys", folder)
        # at most as many as there are quarters between two dates
        spans = [row[0] for row in narrow.select(DAY_QUARTER).distinct().collect()]
        if not null_safe:  # a NULL date matches nothing
            spans = [span for span in spans if span is not None]
        target = target.filter(_in_spans(spans))
        if target.isEmpty():
            return source
        share = held_share(target, narrow, keys, DAY_QUARTER, null_safe).collect()
    free = [row[DAY_QUARTER] for row in share if row["held"] == 0]
    mixed = [row[DAY_QUARTER] for row in share if 0 < row["held"] < row["rows"]]
    parts = [source.filter(_in_spans(free))] if free else []
    if mixed:
        parts.append(rows_to_insert(target.filter(_in_spans(mixed)), source.filter(_in_spans(mixed)), keys, null_safe))
    return reduce(DataFrame.unionByName, parts) if parts else None


def upsert(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: tuple[str, ...],
    partition: str,
    fmt: str = "parquet",
) -> None:
    """Replace the rows the source matches and add the rest; create on first use.

    ``partition`` must be one of ``keys``: then a matched row never changes partition,
    only the source's partitions are read and rewritten, and none of them can be left
    empty. A source that repeats a key raises, on the first load too. Running it again gives the
    same table. The merged partitions are written aside and closed by a marker before the first old one goes, so a run
    that stops anywhere loses no rows: the next one finishes it (``finish_replacements``).
    """
    if partition not in keys:
        raise ValueError(f"partition column {partition!r} must be part of the key {keys}")
    finish_replacements(spark, path)
    with scratch(spark, "upsert") as folder:
        source = staged(spark, source, "source", folder)
        check_unambiguous(source, keys)
        target = read_if_exists(spark, path, fmt)
        if target is None:
            create_table(source, path, [partition], fmt)
            return
        touched = [row[0] for row in source.select(partition).distinct().collect()]
        labels = [value for value in touched if value is not None]
        affected = F.col(partition).isin(*labels) if labels else F.lit(False)
        if len(labels) < len(touched):
            affected = affected | F.col(partition).isNull()
        merged = merge_upsert(target.filter(affected), source, keys)
        replace_partitions(spark, _by_partition(merged, [partition]), path, [partition], fmt=fmt)


def export_csv(rows: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """Header CSV, one file per task, in the order of the rows; quotes in a text are doubled."""
    (
        rows.write.mode("overwrite").option("header", True)
        .option("encoding", encoding).option("escape", '"').csv(path)
    )
