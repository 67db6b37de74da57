"""Exact distinct counts that add up: bitmaps over numbered values, kept for each load, so that a new one needs no second look
at the old rows.

A dictionary gives each value of a kind (a column's name) a number for good. A load stores, for each of its partitions, a bitmap of
the numbers it has seen, cut into buckets of 32,768. Distinct counts over any choice of partitions are the bits set in the buckets' union.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.session import scratch, staged
from rosterlake.sinks.replace import finish_replacements, replace_partitions
from rosterlake.sources.tables import read_if_exists

DICTIONARY, BITMAPS = "dictionary", "bitmaps"


def _values(rows: DataFrame, partition: str, columns: Sequence[str]) -> DataFrame:
    """(partition, kind, value), each once; nulls are no values."""
    texts = rows.select(F.col(partition).cast("string").alias(partition), *(F.col(f"`{c}`").cast("string").alias(f"_{c}") for c in columns))
    long = texts.unpivot([partition], [f"_{c}" for c in columns], "kind", "value").filter("value IS NOT NULL")
    return long.distinct().withColumn("kind", F.expr("substring(kind, 2)"))


def add_load(spark: SparkSession, rows: DataFrame, folder: str, partition: str, columns: Sequence[str]) -> None:
    """Note the distinct values that ``rows`` has in ``columns``, for each value of ``partition``; what an earlier load noted for
    the same partitions is replaced. New values get numbers first, which they keep: a load that stops in between wastes numbers, no more."""
    folder = folder.rstrip("/")
    with scratch(spark, "distinct") as space:
        seen = staged(spark, _values(rows, partition, columns), "values", space)
        known = read_if_exists(spark, f"{folder}/{DICTIONARY}")
        fresh = seen.select("kind", "value").distinct()
        if known is not None:
            fresh = fresh.join(known, ["kind", "value"], "left_anti")
        # numbers run inside a task's range of 2^33; the ranges of a load follow those of all earlier ones
        last = None if known is None else known.agg(F.max("id")).first()[0]
        begin = 0 if last is None else (last >> 33) + 1
        fresh = fresh.withColumn("id", F.monotonically_increasing_id() + (begin << 33))
        fresh = staged(spark, fresh, "fresh", space)
        fresh.write.mode("append").parquet(f"{folder}/{DICTIONARY}")
        numbered = fresh if known is None else read_if_exists(spark, f"{folder}/{DICTIONARY}")
        placed = seen.join(numbered, ["kind", "value"]).select(
            partition, "kind", F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("bit")
        )
        bitmaps = placed.groupBy(partition, "kind", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
        finish_replacements(spark, f"{folder}/{BITMAPS}")
        replace_partitions(spark, bitmaps, f"{folder}/{BITMAPS}", [partition])


def distinct_counts(bitmaps: DataFrame) -> DataFrame:
    """(kind, distinct) over all partitions of ``bitmaps``: filter it for fewer."""
    united = bitmaps.groupBy("kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy("kind").agg(F.sum(F.bitmap_count("bits")).alias("distinct"))


def read_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{BITMAPS}")
