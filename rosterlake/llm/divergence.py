"""How far the vocabularies of sources lie apart: an audit of terms by language and source.

1. Each task makes pointers to the beginnings of terms in the bytes of its Arrow text buffers, a shard of some MB at a time, and sorts them
   by multikey three-way quicksort, eight bytes as a character. Pointers start out by (language, source) and then document,
   and sorting keeps that order: so an equal run is a term, and its stretches of one source and of one document are counts and document frequencies.
2. Spark adds the runs of all shards. A language keeps the terms of at least ``least_documents`` documents.
3. Smoothed shares in billionths, and divergences between them, are whole numbers. Terms are dealt to blocks; a block adds up, for all
   pairs of sources in two groups of ``_SIDE``, what its terms contribute. Terms that neither source of a pair has all contribute the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import LIMITS, release, table
from rosterlake.llm.pointers import places, slices, three_way
from rosterlake.llm.words import text_slices
from rosterlake.operators.joins import fits_broadcast
from rosterlake.session import staged

_SHARD = 4 << 20  # bytes of text that are sorted together; a longer text is a shard of its own
_SIDE = 128  # sources on one side of a block of pairs
_ROWS = 200_000  # rows of a block
_TERMS = 1024  # terms of a block that are set against each other at once
_UNIT = 1_000_000_000
#: Bytes as they are compared: A-Z lower-cased; 0 for a byte that is in no term.
_BYTES = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)
_SUMS = "lang string, side int, slot int, other_side int, other_slot int, value long, seen long"
_RUNS = "lang string, source string, term string, n long, docs long"


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts together, and where each begins (and the last ends)."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def token_bounds(inside: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest stretches of True that cross none of the ``borders``."""
    n = len(inside)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    cut = borders[(borders > 0) & (borders < n)]
    begin[cut] = inside[cut]
    stop[cut - 1] = inside[cut - 1]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Strings of some stretches of a buffer."""
    ends = np.cumsum(sizes)
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    held = data[np.arange(offsets[-1]) + np.repeat(starts - (ends - sizes), sizes)]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(held)).cast(pa.string())


def shard_runs(data: np.ndarray, borders: np.ndarray, group: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """For each (term, group) of a shard: term, group, occurrences and documents. ``group`` is a number for each document."""
    data = _BYTES[data]
    begin, end = token_bounds(data != 0, borders)
    document = np.repeat(np.arange(len(group)), np.diff(np.searchsorted(begin, borders)))
    by_group = np.argsort(group[document], kind="stable")
    begin, end, document = begin[by_group], end[by_group], document[by_group]
    n = len(begin)
    order, first, key = np.arange(n, dtype=np.int32), np.zeros(n, bool), np.zeros(n, np.uint64)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eights = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # eight bytes from every place on
    starts, sizes, depth = np.array([0] if n else [], np.int64), np.array([n] if n else [], np.int64), 0
    while len(starts):
        where = places(starts, sizes)
        at = begin[order[where]] + depth
        left = np.minimum(np.maximum(end[order[where]] - at, 0), 8).astype(np.uint64)
        held = eights[np.minimum(at, len(data))].byteswap()
        empty = np.uint64(8) * (np.uint64(8) - left)
        held = np.where(left > 0, held >> np.minimum(empty, np.uint64(63)) << np.minimum(empty, np.uint64(63)), np.uint64(0))
        key[where] = held
        three_way(order, key, first, starts, sizes)
        starts, sizes = slices(first, starts, sizes)
        # a term that ends inside these eight bytes is done: no term holds a byte 0
        more = (sizes > 1) & (key[starts] & np.uint64(255) != 0)
        starts, sizes, depth = starts[more], sizes[more], depth + 8
    owner, doc = group[document[order]], document[order]
    new = first.copy()
    new[1:] |= owner[1:] != owner[:-1]
    at = np.flatnonzero(new)
    other = new.copy()
    other[1:] |= doc[1:] != doc[:-1]
    return (
        gathered(data, begin[order[at]], end[order[at]] - begin[order[at]]), owner[at], np.diff(np.concatenate((at, [n]))),
        np.add.reduceat(other.astype(np.int64), at) if n else np.zeros(0, np.int64),
    )


def term_runs(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of every shard; a term comes once for each source and shard."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, _SHARD):
                labels = pa.StructArray.from_arrays([part.column("lang"), part.column("source")], ["lang", "source"])
                names = [(x["lang"], x["source"]) for x in labels.to_pylist()]
                known = {x: i for i, x in enumerate(dict.fromkeys(names))}
                terms, owner, n, documents = shard_runs(*text_buffer(part.column("text")), np.array([known[x] for x in names], np.int64))
                owners = pa.array(owner)
                langs, sources = (pa.array([x[i] for x in known], pa.string()).take(owners) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([langs, sources, terms, pa.array(n), pa.array(documents)], names=["lang", "source", "term", "n", "docs"])
        release()

    return _labelled(docs).mapInArrow(count, _RUNS)


def _labelled(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def share(count: str, total: str, terms: str) -> Column:
    """1 + floor(1e9 (count + 1) / (total + terms)), by names of long columns; beyond nine thousand millions by way of decimals.
    Without terms, 1."""
    return F.expr(
        f"CASE WHEN {terms} = 0 THEN 1L WHEN {count} < 9000000000 THEN 1L + {_UNIT}L * ({count} + 1) div ({total} + {terms}) "
        f"ELSE 1L + cast({_UNIT} AS decimal(10,0)) * cast({count} + 1 AS decimal(19,0)) div cast({total} + {terms} AS decimal(19,0)) END"
    )


def _block_sums(block: pd.DataFrame) -> pd.DataFrame:
    """For each two sources, one of side ``i`` and one of side ``j``, both ways: the sum over the block's terms, and how many
    terms that was. Rows without a term give each source's share of an absent one."""
    lang, i, j = block["lang"].iloc[0], int(block["i"].iloc[0]), int(block["j"].iloc[0])
    rows = block[block["term"].notna()].sort_values("term", kind="stable")
    term = pd.factorize(rows["term"])[0]
    side, slot, p = rows["side"].to_numpy(), rows["slot"].to_numpy(), rows["p"].to_numpy()
    n_terms = int(term[-1]) + 1 if len(term) else 0
    absent = {}
    for k in {i, j}:
        own = block[block["term"].isna() & (block["side"] == k)].sort_values("slot")
        absent[k] = own["p"].to_numpy()
    there, back = (np.zeros((len(absent[a]), len(absent[b])), np.int64) for a, b in ((i, j), (j, i)))
    for begin in range(0, n_terms, _TERMS):
        lo, hi = np.searchsorted(term, (begin, begin + _TERMS))
        shares = {}
        for k in {i, j}:
            mine = np.flatnonzero(side[lo:hi] == k) + lo
            shares[k] = np.repeat(absent[k][None, :], min(_TERMS, n_terms - begin), axis=0)
            shares[k][term[mine] - begin, slot[mine]] = p[mine]
        for g in range(len(absent[i])):
            mine = shares[i][:, g : g + 1]
            gap = (mine - shares[j]) ** 2
            there[g] += (gap // shares[j]).sum(axis=0)
            if i != j:
                back[:, g] += (gap // mine).sum(axis=0)
    out = []
    for a, b, sums in ((i, j, there), (j, i, back))[: 1 if i == j else 2]:
        one, two = np.divmod(np.arange(sums.size), sums.shape[1])
        out.append(pd.DataFrame({"side": a, "slot": one, "other_side": b, "other_slot": two, "value": sums.reshape(-1)}))
    return pd.concat(out).assign(lang=lang, seen=n_terms)[[c.split()[0] for c in _SUMS.split(", ")]]


def kept_terms(spark: SparkSession, docs: DataFrame, least_documents: int) -> tuple[DataFrame, DataFrame]:
    """Terms that their language keeps, as (lang, source, term, n, total) for sources that have them, ``total`` being the language's;
    and the groups (lang, source, own, all, terms, number, sources, lang_rows): occurrences of kept terms in the group and in the
    language, how many terms the language keeps, the source's running number in the language, how many sources it has and how many rows of terms."""
    counts = term_runs(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = staged(spark, counts, "term-counts")
    vocabulary = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).filter(F.col("docs") >= least_documents)
    vocabulary = staged(spark, vocabulary.drop("docs"), "vocabulary")
    kept = staged(spark, counts.drop("docs").join(vocabulary, ["lang", "term"]), "kept-terms")
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"), F.count(F.lit(1)).alias("rows"))
    whole = vocabulary.groupBy("lang").agg(F.sum("total").alias("all"), F.count(F.lit(1)).alias("terms"))
    groups = _labelled(docs).select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(whole, "lang", "left")
    groups = groups.na.fill(0, ["own", "rows", "all", "terms"])
    by_lang = Window.partitionBy("lang")
    groups = groups.select(
        "lang", "source", "own", "all", "terms", (F.row_number().over(by_lang.orderBy("source")) - 1).alias("number"),
        F.count(F.lit(1)).over(by_lang).alias("sources"), F.sum("rows").over(by_lang).alias("lang_rows"),
    )
    return kept, staged(spark, groups, "sources")


def beside(rows: DataFrame, groups: DataFrame, on: list[str]) -> DataFrame:
    """Inner join to ``groups``, which goes to all tasks if it was measured to be small."""
    return rows.join(F.broadcast(groups) if fits_broadcast(groups, LIMITS) else groups, on)


def pair_divergence(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each two sources of a language, both ways."""
    placed = groups.select(
        "lang", "source", "own", "all", "terms", F.floor(F.col("number") / _SIDE).cast("int").alias("side"), (F.col("number") % _SIDE).alias("slot"),
        F.ceil(F.col("sources") / _SIDE).cast("int").alias("sides"), F.lit(0).cast("long").alias("none"),
    ).withColumn("p", share("none", "own", "terms"))
    # so many blocks that one holds about _ROWS rows, by the number of rows in the language
    ways = groups.select("lang", F.greatest(F.ceil(2 * F.col("lang_rows") / F.ceil(F.col("sources") / _SIDE) / _ROWS), F.lit(1)).cast("int").alias("ways")).distinct()
    placed = placed.join(ways, "lang")
    names = beside(kept.select("lang", "source", "term", "n"), placed.drop("p"), ["lang", "source"])
    block = ("lang", "i", "j", "way")
    apart = [F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j")]
    every_side = F.explode(F.sequence(F.lit(0), F.col("sides") - 1)).alias("other")
    terms = names.select(
        "lang", "side", "slot", "term", share("n", "own", "terms").alias("p"), F.pmod(F.xxhash64("term"), F.col("ways")).cast("int").alias("way"), every_side
    )
    absent = placed.select("lang", "side", "slot", F.lit(None).cast("string").alias("term"), "p", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)).alias("way"), "sides")
    absent = absent.select("lang", "side", "slot", "term", "p", "way", every_side)
    sums = terms.unionByName(absent).select(*block[:1], *apart, "way", "side", "slot", "term", "p").groupBy(*block).applyInPandas(_block_sums, _SUMS)
    sums = sums.groupBy("lang", "side", "slot", "other_side", "other_slot").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    mine = placed.select("lang", "side", "slot", "source", "terms", F.col("p").alias("p"))
    other = placed.select("lang", F.col("side").alias("other_side"), F.col("slot").alias("other_slot"), F.col("source").alias("item"), F.col("p").alias("q"))
    pairs = beside(beside(sums, mine, ["lang", "side", "slot"]), other, ["lang", "other_side", "other_slot"]).filter("source <> item")
    return pairs.select("lang", "source", "item", (F.col("value") + (F.col("terms") - F.col("seen")) * F.expr("(p - q) * (p - q) div q")).alias("value"))


def term_divergence(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each kept term that a source has more often than its language."""
    rated = beside(kept, groups.select("lang", "source", "own", "all", "terms"), ["lang", "source"])
    rated = rated.select("lang", "source", F.col("term").alias("item"), share("n", "own", "terms").alias("p"), share("total", "all", "terms").alias("q"))
    return rated.filter("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))


def audit(spark: SparkSession, docs: DataFrame, least_documents: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank: all pairs of sources of each language (part ``pair``), and of each source the ``top``
    terms that set it apart from its language (part ``term``).

    Null lang, source or text count as empty. Every row of ``docs`` is a document, rows that repeat another as well. A source without
    terms still has pairs; where a language keeps no term, their value is 0. Ties rank by item. An empty table gives no rows, and columns other than
    lang, source and text are not looked at.
    """
    kept, groups = kept_terms(spark, docs, least_documents)
    by_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    parts = [("pair", pair_divergence(kept, groups), None), ("term", term_divergence(kept, groups), top)]
    found = []
    for part, rows, most in parts:
        ranked = rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(by_group).alias("rank"))
        found.append(ranked if most is None else ranked.filter(F.col("rank") <= most))
    return found[0].unionByName(found[1])


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents."""
    return audit(spark, table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
v AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
vs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM v GROUP BY lang),
k AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN v ON w.lang = v.lang AND w.term = v.term GROUP BY ALL),
g AS (SELECT d.lang, d.source, any_value(coalesce(vs.v, 0)) AS v FROM (SELECT DISTINCT lang, source FROM d) d LEFT JOIN vs ON vs.lang = d.lang GROUP BY ALL),
gs AS (SELECT g.lang, g.source, g.v, coalesce(sum(k.n), 0) AS n FROM g LEFT JOIN k ON k.lang = g.lang AND k.source = g.source GROUP BY ALL),
p AS (SELECT gs.lang, gs.source, v.term, coalesce(k.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(k.n, 0) + 1)) // (gs.n + gs.v)::HUGEINT) AS p,
    (1 + (1000000000::HUGEINT * (v.n + 1)) // (vs.n + vs.v)::HUGEINT) AS q
  FROM gs JOIN v ON v.lang = gs.lang JOIN vs ON vs.lang = gs.lang LEFT JOIN k ON k.lang = gs.lang AND k.source = gs.source AND k.term = v.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce((
    SELECT sum((x.p - y.p) * (x.p - y.p) // y.p) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
    WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM gs a JOIN gs b ON a.lang = b.lang AND a.source <> b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= 200
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked
"""
