"""Helpers shared by the corpus operators: reading, block-wise batches, joins on keys that may be hot."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.config import Settings
from rosterlake.operators.joins import fits_broadcast, lookup_size

#: What one lookup that goes to all tasks may have.
LIMITS = Settings(broadcast_max_rows=100_000, broadcast_max_bytes=16 << 20)
#: Rows of one key that may stay together: this share of all rows, or this many.
HOT_SHARE, HOT_ROWS = 1 / 1000, 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_columns(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``rows`` with more columns; an input column of the same name gives way."""
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in columns]
    return rows.select(*kept, *(value.alias(name) for name, value in columns.items()))


def text_blocks(
    keys: Iterable, texts: Iterable[str | None], most_chars: int
) -> Iterator[tuple[list, list[str]]]:
    """Consecutive rows in groups of about ``most_chars`` characters, so that array work on a
    batch needs the same memory whatever the batch holds. A longer text is a group of its own."""
    some_keys, some_texts, size = [], [], 0
    for key, text in zip(keys, texts):
        text = text or ""
        if some_texts and size + len(text) > most_chars:
            yield some_keys, some_texts
            some_keys, some_texts, size = [], [], 0
        some_keys.append(key)
        some_texts.append(text)
        size += len(text)
    if some_texts:
        yield some_keys, some_texts


def release() -> None:
    """Give memory back that a Python worker has used and freed: workers live on from task to task and
    share their executor's memory with the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Budget:
    """Bytes that the lookups of one run may take together when they go to all tasks. A run may hold them all until it ends."""

    def __init__(self, size: int = 256 << 20):
        self.left = size

    def takes(self, lookup: DataFrame) -> bool:
        """Whether ``lookup``, measured, is small and still fits; if so its size is taken off."""
        rows, size = lookup_size(lookup)
        if rows > LIMITS.broadcast_max_rows or size > min(LIMITS.broadcast_max_bytes, self.left):
            return False
        self.left -= size
        return True


def join_counted(
    facts: DataFrame, counted: DataFrame, key: str, spread: Column, total: int, n: str = "n", budget: Budget | None = None
) -> DataFrame:
    """Left join of ``facts`` to ``counted``: one row for each key, with the number of facts
    that have it in column ``n``.

    A small ``counted`` (rows and bytes are measured) is broadcast, within the ``budget`` of a run that joins often. Else a key with more than
    ``HOT_SHARE`` of the ``total`` facts is split: there are at most ``1 / HOT_SHARE`` of those,
    they go to all tasks, and each fact of such a key picks one of the key's salts by ``spread``.
    """
    if budget.takes(counted) if budget else fits_broadcast(counted):
        return facts.join(F.broadcast(counted), key, "left")
    limit = max(HOT_ROWS, int(total * HOT_SHARE))
    hot = counted.filter(F.col(n) > limit).select(
        F.col(key).alias("_hot"), F.ceil(F.col(n) / limit).cast("int").alias("_ways")
    )
    ways = F.coalesce(F.col("_ways"), F.lit(1))
    left = facts.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.pmod(spread, ways).cast("int")
    ).drop("_hot", "_ways")
    right = counted.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col(n) / limit).cast("int"), F.lit(1)) - 1))
    )
    # a key at or under the limit has the one salt 0 on both sides
    return left.join(right, [key, "_salt"], "left").drop("_salt")
