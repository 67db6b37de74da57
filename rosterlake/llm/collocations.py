"""Collocations: frequent phrases that are more than the sum of their parts, mined level by level.

Each task makes pointers to the words of a shard of some MB (a pointer stands for the suffix that begins there, up to the end of its
piece) and sorts them by multikey three-way quicksort with a word as a character. The partition of pointers that agree
in ``d`` words has the size of its phrase's count in the shard. The sizes of all shards are routed by language and leading words and
added up, and partitions that stay under the least count are abandoned: the next level's pointers are only those whose
words (then pairs of words) are all frequent. Which are is told to the tasks by a Bloom filter of bounded size; what
it lets through by chance is counted as well, and dropped by its exact sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import LIMITS, Budget, join_counted, release, table
from rosterlake.llm.divergence import text_buffer, token_bounds
from rosterlake.llm.pointers import slices, three_way
from rosterlake.llm.words import text_slices
from rosterlake.operators.joins import fits_broadcast
from rosterlake.session import staged

WORDS = 4  # of the longest phrase
_SHARD = 4 << 20  # bytes of text that are sorted together; a longer text is a shard of its own
_FILTER_BITS = 16, 28  # powers of two: least and most bits of a filter; 32 MB at most
_SALTS = 64
_SPACE, _BREAK = 1, 2
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _byte_table() -> tuple[np.ndarray, np.ndarray]:
    lowered, kind = np.arange(256, dtype=np.uint8), np.zeros(256, np.uint8)
    lowered[65:91] += 32
    kind[[0x20, 0x09]] = _SPACE
    kind[[*b".,;:!?\n\x0b\x0c\r"]] = _BREAK
    return lowered, kind


_LOWERED, _KIND = _byte_table()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


def _hashes(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)


def phrase_keys(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases, from those of the language and of each word."""
    key = _mix(lang + np.uint64(len(words)))
    for word in words:
        key = _mix(key + word)
    return key


def _bits(keys: np.ndarray, n_slots: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places of a key in a filter of ``n_slots`` (a power of two) 64-bit slots."""
    for odd in _ODD:
        z = keys * odd
        yield (z >> np.uint64(32)) & np.uint64(n_slots - 1), np.uint64(1) << (z >> np.uint64(26) & np.uint64(63))


def passes(slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
    ok = np.ones(len(keys), bool)
    for slot, bit in _bits(keys, len(slots)):
        ok &= slots[slot.astype(np.int64)] & bit != 0
    return ok


def frequent_filter(spark: SparkSession, frequent: DataFrame) -> Broadcast:
    """A Bloom filter of all phrases in ``frequent`` (lang, phrase): about 16 bits for each, within ``_FILTER_BITS``. Tasks fill
    parts, which are joined by bitwise or; only the filter itself reaches the driver."""
    n = frequent.count()
    n_slots = 1 << (min(max((16 * n).bit_length(), _FILTER_BITS[0]), _FILTER_BITS[1]) - 6)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_slots, np.uint64)
        for batch in batches:
            phrases = [p.split(" ") for p in batch.column("phrase").to_pylist()]
            if not phrases:
                continue
            langs, words = _hashes(batch.column("lang").to_pylist()), [_hashes(list(w)) for w in zip(*phrases)]
            for slot, bit in _bits(phrase_keys(langs, words), n_slots):
                np.bitwise_or.at(held, slot.astype(np.int64), bit)
        some = np.flatnonzero(held)
        for begin in range(0, len(some), 1 << 16):
            part = some[begin : begin + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(held[part].view(np.int64))], names=["slot", "bits"])

    parts = frequent.select("lang", "phrase").mapInArrow(fill, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    got = parts.toArrow()
    slots = np.zeros(n_slots, np.uint64)
    slots[got.column("slot").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(slots)


class Shard:
    """The words of some texts: code of each, its text, and whether its piece ends with it."""

    def __init__(self, data: np.ndarray, borders: np.ndarray):
        data = _LOWERED[data]
        kind = _KIND[data]
        inside = kind == 0
        begin, end = token_bounds(inside, borders)
        offsets = np.concatenate(([0], np.cumsum(end - begin)))
        held = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
        coded = held.dictionary_encode()
        self.code, self.words = np.asarray(coded.indices, np.int64), coded.dictionary.cast(pa.string())
        self.text = np.repeat(np.arange(len(borders) - 1), np.diff(np.searchsorted(begin, borders)))
        breaks = np.cumsum(kind == _BREAK)[begin] if len(begin) else begin
        self.last = np.ones(len(begin), bool)
        self.last[:-1] = (breaks[1:] != breaks[:-1]) | (self.text[1:] != self.text[:-1])

    def alive(self, ok: np.ndarray, width: int, depth: int) -> np.ndarray:
        """Where a phrase of ``depth`` words begins all of whose parts of ``width`` words are ``ok``."""
        out, n = ok.copy(), len(ok)
        for i in range(depth - 1):  # no piece ends before the last word
            out[: max(n - i, 0)] &= ~self.last[i:]
        for i in range(1, depth - width + 1):
            out[: max(n - i, 0)] &= ok[i:]
        return out

    def follow(self, i: int) -> np.ndarray:
        """Code of the ``i``-th word from each one on; any number beyond the last."""
        return self.code if not i else np.concatenate((self.code[i:], np.zeros(min(i, len(self.code)), np.int64)))

    def partitions(self, lang: np.ndarray, ok: np.ndarray, width: int, least: int, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each depth from ``least`` to ``most``: a pointer of each partition of equal suffixes, and its size."""
        order = np.flatnonzero(self.alive(ok, width, least)).astype(np.int32)
        n = len(order)
        first, key = np.zeros(n, bool), np.zeros(n, np.int64)
        starts, sizes = np.zeros(min(n, 1), np.int64), np.full(min(n, 1), n, np.int64)
        for depth in range(1, most + 1):
            character = self.follow(depth - 1)
            if depth == 1:
                character = lang[self.text] * (len(self.words) + 1) + character
            elif depth > least:
                character = np.where(self.alive(ok, width, depth), character, -1)
            key[:] = character[order]
            three_way(order, key, first, starts, sizes)
            starts, sizes = slices(first, starts, sizes)
            on = key[starts] >= 0
            starts, sizes = starts[on], sizes[on]
            if depth >= least:
                yield depth, order[starts], sizes


def phrase_counts(docs: DataFrame, least: int, most: int, width: int = 1, gate: Broadcast | None = None) -> DataFrame:
    """(lang, phrase, words, n): how often phrases of ``least`` to ``most`` words occur, those all of whose parts of ``width``
    words pass the ``gate``. Sizes of the shards' partitions are added by language and phrase."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, _SHARD):
                shard = Shard(*text_buffer(part.column("text")))
                coded = part.column("lang").dictionary_encode()
                lang, langs = np.asarray(coded.indices, np.int64), coded.dictionary
                ok = np.ones(len(shard.code), bool)
                if gate is not None:
                    hashed = _hashes(shard.words.to_pylist())
                    own = _hashes(langs.to_pylist())[lang][shard.text]
                    ok = shard.alive(ok, width, width)
                    at = np.flatnonzero(ok)
                    ok[at] = passes(gate.value, phrase_keys(own[at], [hashed[shard.follow(i)[at]] for i in range(width)]))
                for depth, pointer, size in shard.partitions(lang, ok, width, least, most):
                    words = [shard.words.take(pa.array(shard.follow(i)[pointer])) for i in range(depth)]
                    phrases = pc.binary_join_element_wise(*words, " ") if depth > 1 else words[0]
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(pa.array(lang[shard.text[pointer]])), phrases, pa.array(np.full(len(size), depth, np.int32)), pa.array(size.astype(np.int64))],
                        names=["lang", "phrase", "words", "n"],
                    )
        release()

    labelled = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    runs = labelled.mapInArrow(count, "lang string, phrase string, words int, n long")
    return runs.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))


def frequent_phrases(spark: SparkSession, docs: DataFrame, least_count: int) -> tuple[DataFrame, DataFrame]:
    """Phrases of one to ``WORDS`` words that occur at least ``least_count`` times, as (lang, phrase, words, f); and
    the number of words of each language, as (lang, n)."""
    words = staged(spark, phrase_counts(docs, 1, 1), "words")
    often = F.col("n") >= least_count
    found = [words.filter(often)]
    pairs = staged(spark, phrase_counts(docs, 2, 2, 1, frequent_filter(spark, found[0])).filter(often), "pairs")
    longer = phrase_counts(docs, 3, WORDS, 2, frequent_filter(spark, pairs)).filter(often)
    found += [pairs, staged(spark, longer, "longer")]
    frequent = found[0].unionByName(found[1]).unionByName(found[2]).withColumnRenamed("n", "f")
    return frequent, words.groupBy("lang").agg(F.sum("n").alias("n"))


def _score(a: str, left: str, right: str) -> Column:
    """floor(2000000 a / (left + right)), by names of long columns."""
    return F.expr(f"cast(2000000 AS decimal(7,0)) * cast({a} AS decimal(19,0)) div (cast({left} AS decimal(19,0)) + cast({right} AS decimal(19,0)))")


def scored(spark: SparkSession, frequent: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of each phrase of several words: by the cut that scores lowest, the earliest of those."""
    phrases = frequent.filter("words > 1")
    cuts = phrases.select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    sides = cuts.select("lang", "phrase", "words", "a", "k", F.posexplode(F.array(
        F.expr("substring_index(phrase, ' ', k)"), F.expr("substring_index(phrase, ' ', k - words)")
    )).alias("side", "part"))
    sides = staged(spark, sides.select(F.struct("lang", "part").alias("part"), "phrase", "words", "a", "k", "side"), "parts")
    asked = sides.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    known = asked.join(frequent.select(F.struct("lang", F.col("phrase").alias("part")).alias("part"), "f"), "part")
    met = join_counted(sides, staged(spark, known, "part-counts"), "part", F.xxhash64("phrase", "k"), sides.count(), budget=Budget())
    every = range(1, WORDS)
    wide = met.groupBy(F.col("part.lang").alias("lang"), "phrase", "words", "a").agg(
        *(F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("f"))).alias(f"{name}{k}") for k in every for side, name in enumerate("lr"))
    )
    best = F.array_min(F.array_compact(F.array(*(
        F.when(F.col("words") > k, F.struct(_score("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        for k in every
    ))))
    return wide.select("lang", "phrase", "words", "a", best.alias("best")).select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def not_inside_others(rows: DataFrame, share: int = 80) -> DataFrame:
    """Without the phrases that lie inside a longer one which occurs at least ``share`` percent as often."""
    apart = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda at: F.array_join(F.slice(apart, at, m), " "))))
    longest = rows.filter("words > 2").select("lang", F.col("a").alias("most"), F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    wide = F.expr(f"cast(100 AS decimal(3,0)) * cast(most AS decimal(19,0)) >= cast({share} AS decimal(3,0)) * cast(a AS decimal(19,0))")
    return rows.join(longest, ["lang", "phrase"], "left").filter(~F.coalesce(wide, F.lit(False))).drop("most")


def collocations(spark: SparkSession, docs: DataFrame, least_count: int = 30, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases by score, then count, then phrase.

    A null lang is ``und``, a null text empty; rows that repeat another count again. Phrases that occur fewer than ``least_count`` times, and those
    inside longer ones about as frequent, are no candidates. A table without any, an empty one too, gives no rows. Columns other than lang and text are not looked at.
    """
    frequent, sizes = frequent_phrases(spark, docs, least_count)
    rows = not_inside_others(staged(spark, scored(spark, frequent), "scored"))
    by = (F.desc("score"), F.desc("a"), F.col("phrase"))
    # the first of each of some parts of a language, then of these: no task sorts a whole language
    part = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*by))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by)).cast("long")).filter(F.col("rank") <= top)
    whole = F.broadcast(sizes) if fits_broadcast(sizes, LIMITS) else sizes
    return ranked.join(whole, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collocations of all documents."""
    return collocations(spark, table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH p AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
),
s AS (SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
v AS MATERIALIZED (SELECT piece, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS place FROM s),
o AS (SELECT lang, w1, lead(w1, 1) OVER q AS w2, lead(w1, 2) OVER q AS w3, lead(w1, 3) OVER q AS w4 FROM v WINDOW q AS (PARTITION BY piece ORDER BY place)),
k AS (SELECT unnest(range(1, 5)) AS m),
f AS MATERIALIZED (
  SELECT lang, m, phrase, count(*) AS f FROM (
    SELECT lang, m, CASE m WHEN 1 THEN w1 WHEN 2 THEN w1 || ' ' || w2 WHEN 3 THEN w1 || ' ' || w2 || ' ' || w3 ELSE w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 END AS phrase
    FROM o, k
  ) WHERE phrase IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
u AS MATERIALIZED (
  SELECT c.lang, c.m, c.phrase, c.a, k.m AS cut, array_to_string(c.w[1:k.m], ' ') AS head, array_to_string(c.w[k.m + 1:], ' ') AS tail FROM c JOIN k ON k.m < c.m
),
x AS (
  SELECT u.*, l.f AS l, r.f AS r, (2000000::HUGEINT * u.a) // (l.f + r.f) AS score
  FROM u JOIN f l ON l.lang = u.lang AND l.phrase = u.head JOIN f r ON r.lang = u.lang AND r.phrase = u.tail
),
b AS MATERIALIZED (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS MATERIALIZED (
  SELECT lang, m2 AS m, phrase, max(a) AS most FROM (
    SELECT c.lang, k.m AS m2, c.a, unnest(list_transform(range(1, c.m - k.m + 2), lambda i: array_to_string(c.w[i:i + k.m - 1], ' '))) AS phrase
    FROM c JOIN k ON k.m > 1 AND k.m < c.m
  ) GROUP BY ALL
),
t AS (SELECT lang, count(*) AS n FROM v GROUP BY lang)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, b.l, b.r, t.n, b.score::BIGINT AS score
FROM b JOIN t ON t.lang = b.lang LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase AND i.m = b.m
WHERE i.most IS NULL OR 100 * i.most < 80 * b.a
QUALIFY row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) <= 2000
"""
