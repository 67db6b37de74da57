"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered in the order of some of their columns. The permutation deals in numbers below ``a * b``, ``a`` being the rounded
root of the number of rows and ``b`` the least number that suffices; a result that is no row number is permuted again (cycle
walking) until it is one. The new position tells shard (position modulo shards) and slot (position divided by shards): both can be
computed from any row number, and the row number from any shard and slot, without a table. Shards differ by one row at most.
Column expressions only.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from itertools import accumulate
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm.common import table, with_columns
from rosterlake.session import staged

ROUNDS = 6
#: A walk is rarer than one in the root of the number of rows. Up to 4,096 rows there are fewer numbers than this to walk over; beyond,
#: so many walks in a row have a probability below 2 to the power of -384, and would raise an error.
_WALKS = 64
_AT = (1 << 33) - 1  # the part of a monotonically increasing id that counts inside a partition


def _halves(rows: int) -> tuple[int, int]:
    a = isqrt(max(rows - 1, 0)) + 1
    return a, max(-(-rows // a), 1)


def _hashed(seed: int, turn: Column, half: Column) -> Column:
    """60 bits from the md5 of seed, round and a half."""
    text = F.concat_ws(":", F.lit(str(seed)), turn.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _rounds(number: Column, rows: int, seed: int, back: bool) -> Column:
    """All rounds once. Each adds a hash of the right half to the left one and swaps them; the left half is below ``a`` in even
    rounds and below ``b`` in odd ones."""
    a, b = (F.lit(x).cast("long") for x in _halves(rows))

    def forth(state: Column, turn: Column) -> Column:
        size = F.when(turn % 2 == 0, a).otherwise(b)
        mixed = (state["left"] + _hashed(seed, turn, state["right"]) % size) % size
        return F.struct(state["right"].alias("left"), mixed.alias("right"))

    def undo(state: Column, turn: Column) -> Column:
        size = F.when(turn % 2 == 0, a).otherwise(b)
        plain = F.pmod(state["right"] - _hashed(seed, turn, state["left"]) % size, size)
        return F.struct(plain.alias("left"), state["left"].alias("right"))

    start = F.struct(((number - number % b) / b).cast("long").alias("left"), (number % b).alias("right"))
    turns = F.array(*(F.lit(i) for i in sorted(range(ROUNDS), reverse=back)))
    return F.aggregate(turns, start, undo if back else forth, lambda state: state["left"] * b + state["right"])


def _walked(number: Column, rows: int, seed: int, back: bool) -> Column:
    a, b = _halves(rows)
    once = _rounds(number, rows, seed, back)
    walks = min(a * b - rows, _WALKS)
    if not walks:
        return once
    inside = F.aggregate(
        F.sequence(F.lit(1), F.lit(walks)), once, lambda at, _: F.when(at < rows, at).otherwise(_rounds(at, rows, seed, back))
    )
    return F.when(inside < rows, inside).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def position(number: Column, rows: int, seed: int = 0) -> Column:
    """Where the row of a number (0 to ``rows`` - 1, a long) stands after the shuffle: a permutation of these numbers."""
    return _walked(number, rows, seed, False)


def number_at(place: Column, rows: int, seed: int = 0) -> Column:
    """The number of the row that stands at a position: ``position`` undone."""
    return _walked(place, rows, seed, True)


def numbered(spark: SparkSession, rows: DataFrame, by: Sequence[str], number: str = "row_number") -> tuple[DataFrame, int]:
    """``rows`` with running numbers from 0 in the order of ``by`` (nulls first), and how many there are.

    ``rows`` must come from stored tables, so that a repeated task sees them as before. Which of several rows that agree in ``by`` comes
    first depends on how they are stored. They may be any number: ranges of rows are cut inside such a group, too.
    The rows move once and are written to shared storage; only the size of each range reaches the driver.
    """
    order = [*(F.col(f"`{c}`").asc_nulls_first() for c in by), F.col("_tie").asc()]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
    held = staged(
        spark, ranged.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().bitwiseAND(F.lit(_AT)).alias("_at")), "ranges"
    )
    sizes = dict(held.groupBy("_range").agg(F.count(F.lit(1))).collect())
    begin = [0, *accumulate(sizes.get(i, 0) for i in range(max(sizes, default=-1) + 1))]
    starts = F.expr(f"array({', '.join(f'{x}L' for x in begin)})")
    return with_columns(held, {number: F.element_at(starts, F.col("_range") + 1) + F.col("_at")}).drop("_range", "_at"), begin[-1]


def sharded(spark: SparkSession, docs: DataFrame, shards: int, by: Sequence[str] = ("doc_id",), seed: int = 0) -> DataFrame:
    """``docs`` with ``row_number``, ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    Null keys come first, rows with equal keys are numbered one after the other and so shuffled like any others, an empty table gives none,
    and input columns with the names of the new ones give way. No other column is looked at.
    """
    held, rows = numbered(spark, docs, by)
    place = position(F.col("row_number"), rows, seed)
    return with_columns(with_columns(held, {"shard": place}), {"slot": F.floor(F.col("shard") / shards).cast("long"), "shard": (F.col("shard") % shards).cast("int")})


def write_shards(spark: SparkSession, docs: DataFrame, folder: str, shards: int, by: Sequence[str] = ("doc_id",), seed: int = 0) -> None:
    """Parquet files below ``shard=<number>``, each with consecutive slots in order. Whole rows move twice: to be numbered, and to their places."""
    placed = sharded(spark, docs, shards, by, seed)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards, numbered by doc_id (then size and checksum of the text); texts themselves need not move."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = sharded(spark, docs, 16, ("doc_id", "size", "text_crc32"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


_CRC = ", ".join(str(zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF) for b in range(256))  # of each byte alone

OP12_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, list_reduce(
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT),
    lambda crc, byte: xor(crc >> 8, [{_CRC}][(xor(crc, byte) & 255) + 1]), 4294967295) AS crc
  FROM documents
),
k AS (SELECT doc_id, size::BIGINT AS size, xor(crc, 4294967295) AS text_crc32,
  row_number() OVER (ORDER BY doc_id NULLS FIRST, size, xor(crc, 4294967295)) - 1 AS num FROM d),
c AS (SELECT count(*) AS n, ceil(sqrt(count(*)))::BIGINT AS a FROM k),
h AS (SELECT n, a, ceil(n / a)::BIGINT AS b FROM c),
walk AS (
  SELECT num, num // b AS l, num % b AS r, 0 AS turn FROM k, h
  UNION ALL
  SELECT num, r, (l + ('0x' || substr(md5('0:' || (turn % {ROUNDS})::VARCHAR || ':' || r::VARCHAR), 1, 15))::BIGINT % CASE WHEN turn % 2 = 0 THEN a ELSE b END)
    % CASE WHEN turn % 2 = 0 THEN a ELSE b END, turn + 1
  FROM walk, h WHERE turn = 0 OR turn % {ROUNDS} <> 0 OR l * b + r >= n
)
SELECT doc_id, size, text_crc32, 'rows' AS law, ((l * b + r) % 16)::INT AS shard, (l * b + r) // 16 AS slot, NULL::INT AS grown_shard
FROM walk JOIN k USING (num), h WHERE turn > 0 AND turn % {ROUNDS} = 0 AND l * b + r < n
"""
