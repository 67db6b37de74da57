"""Near-duplicate classes by weighted Jaccard similarity of word shingles.

1. BagMinHash signatures: every element (a shingle with its count in the text) is a hierarchy of Poisson
   processes over discretised weights, and a register keeps its earliest point. Two texts agree in a
   register with the probability of their weighted Jaccard similarity. Equal texts share one node from here on.
2. Bands of registers make buckets. In each, the most central node (that shares most buckets with others) is
   the pivot, and members are verified against it by the exact overlap of the shingle multisets.
3. Links make classes (connected components). Members outside their pivots' classes elect a new pivot among
   themselves, until a round adds no link.
4. In buckets that still hold several classes, members of different ones are compared. One minus the similarity is a distance that obeys
   the triangle inequality, so two members whose distances to the bucket's first pivot differ by more than the
   threshold allows are unlike. Of the rest, coarse counts of shingles give an upper bound of a pair's similarity,
   and pairs that it lets through are verified. A class of many members is passed once for every few hundred strays beside it.

So two texts that share a bucket are in one class, or known to be unlike. Most pairs of a large class are never
looked at; hot buckets, texts and classes are split by salt, those of step 4 into blocks. What is broadcast is measured, and
stays within one budget for the whole run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm.common import LIMITS, Budget, join_counted, release, table, text_blocks
from rosterlake.llm.words import Memo
from rosterlake.operators.joins import fits_broadcast
from rosterlake.session import staged

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CHILDREN = np.array([0x8CB92BA72F3D8DD7, 0xE7037ED1A0B428DB], np.uint64)  # for the seeds of an interval's halves
_BLOCK = 1 << 18
_PART = 512  # members of a bucket that are compared as one part
_CHUNK = 4096  # members of a large class that one such part is compared with at once
_CELLS = 64, 4096  # fewest and most cells of coarse counts


@dataclass(frozen=True)
class NearParams:
    """``bands`` of ``rows`` registers: with 42 of 6, two texts of similarity 0.8 share a band with
    probability 0.999997, two of 0.3 with 0.03. ``words`` in a shingle; a shorter text is one shingle."""

    threshold: float = 0.8
    words: int = 5
    bands: int = 42
    rows: int = 6


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_words(words: list[str]) -> list[int]:
    return [xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words]


def _memo() -> Memo:
    global _MEMO
    try:
        return _MEMO
    except NameError:
        _MEMO = Memo(_hash_words)
        return _MEMO


def shingles(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text number, hash, and how often it occurs; in no order."""
    memo, size = _memo(), words
    parts, lengths = [], []
    for text in texts:
        own = text.split()
        memo.learn(own)
        hashes = np.array([memo[w] for w in own], np.uint64)
        if 0 < len(hashes) < size:
            hashes = np.concatenate((hashes, np.zeros(size - len(hashes), np.uint64)))
        parts.append(hashes)
        lengths.append(len(hashes))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    if len(flat) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(flat) - size + 1
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h += _mix(flat[j : j + n] + np.uint64(j)) * _ODD[j % len(_ODD)]
    inside = owner[:n] == owner[size - 1 :]
    owner, h = owner[:n][inside], _mix(h[inside])
    key = _mix(h + owner.astype(np.uint64) * _STEP)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(np.concatenate((first, [len(key)])))
    return owner[order[first]], h[order[first]], count


def bag_min_hash(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n_texts: int, registers: int) -> np.ndarray:
    """Signatures, one row of arrival times for each text; infinite where a text has no element.

    Weights are discretised at whole numbers. The intervals [0,1), [1,2), [2,4), [4,8)... of an element's weight each
    carry a Poisson process with as much rate as width, and a point picks a register. An interval's first point
    splits it: one half keeps the point, the other draws its own from there on; halves above the weight are dropped. All
    texts split alike, so equal shares of weight see equal points. Points later than a text's last register matter to none.
    """
    regs = np.full((n_texts, registers), np.inf)
    flat = regs.reshape(-1)
    if not len(owner):
        return regs
    top = 1 + int(np.log2(weight.max()))
    own, seed, lo, hi, least = [], [], [], [], []
    for k in range(-1, top):
        a, b = (0, 1) if k < 0 else (1 << k, 2 << k)
        some = weight > a
        own.append(owner[some])
        seed.append(_mix(element[some] + np.array([k + 2], np.uint64) * _STEP))
        lo.append(np.full(some.sum(), a))
        hi.append(np.full(some.sum(), b))
        least.append(weight[some])
    own, seed, lo, hi, least = map(np.concatenate, (own, seed, lo, hi, least))

    def draw(seed: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = _mix(seed + (turn + 1).astype(np.uint64) * _STEP)
        wait = -np.log(((z >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        y = _mix(z ^ np.uint64(0x5851F42D4C957F2D))
        return wait, ((y >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64), (y & np.uint64(1)).astype(bool)

    def note(own: np.ndarray, reg: np.ndarray, t: np.ndarray) -> None:
        np.minimum.at(flat, own * registers + reg, t)

    turn = np.zeros(len(own), np.int64)
    wait, reg, _ = draw(seed, turn)
    t = wait / (hi - lo)
    full = hi <= least
    note(own[full], reg[full], t[full])
    while True:
        live = t <= regs.max(axis=1)[own]
        if not live.any():
            return regs
        own, seed, lo, hi, least, turn, reg, t = (x[live] for x in (own, seed, lo, hi, least, turn, reg, t))
        unit = hi - lo == 1
        new: list[tuple] = []
        if unit.any():
            u = [x[unit] for x in (own, seed, lo, hi, least, turn, reg, t)]
            many = int(min(64, max(1, 65536 // unit.sum())))
            turns = u[5][:, None] + np.arange(1, many + 1)
            waits, picks, _ = draw(np.repeat(u[1], many), turns.reshape(-1))
            waits, picks = waits.reshape(-1, many), picks.reshape(-1, many)
            waits[:, 0] += u[7]
            times = np.cumsum(waits, axis=1)
            note(np.repeat(u[0], many), picks.reshape(-1), times.reshape(-1))
            new.append((u[0], u[1], u[2], u[3], u[4], turns[:, -1], picks[:, -1], times[:, -1]))
        if not unit.all():
            own_, seed_, lo_, hi_, least_, _, reg_, t_ = (x[~unit] for x in (own, seed, lo, hi, least, turn, reg, t))
            mid = (lo_ + hi_) // 2
            _, _, right = draw(seed_, np.full(len(seed_), 1 << 20))
            for side in (False, True):
                a, b = (mid, hi_) if side else (lo_, mid)
                child = _mix(seed_ + _CHILDREN[int(side)])
                wait, fresh, _ = draw(child, np.zeros(len(child), np.int64))
                holds = right == side
                when, where = np.where(holds, t_, t_ + wait / (b - a)), np.where(holds, reg_, fresh)
                keep = a < least_
                done = keep & (b <= least_)
                note(own_[done], where[done], when[done])
                new.append((own_[keep], child[keep], a[keep], b[keep], least_[keep], np.zeros(keep.sum(), np.int64), where[keep], when[keep]))
        own, seed, lo, hi, least, turn, reg, t = map(np.concatenate, zip(*new))


def band_keys(texts: list[str], params: NearParams) -> list[np.ndarray]:
    """Each text's bucket keys; none for a text without words."""
    owner, element, weight = shingles(texts, params.words)
    regs = bag_min_hash(owner, element, weight, len(texts), params.bands * params.rows)
    bits = regs.view(np.uint64).reshape(len(texts), params.bands, params.rows)
    odd = _mix(np.arange(1, params.rows + 1, dtype=np.uint64) * _STEP) | np.uint64(1)
    keys = _mix((_mix(bits) * odd).sum(axis=2, dtype=np.uint64) + np.arange(params.bands, dtype=np.uint64) * _ODD[2])
    has = np.isfinite(regs[:, 0])
    return [row if ok else row[:0] for row, ok in zip(keys.view(np.int64), has)]


def _digest(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def signatures(docs: DataFrame, params: NearParams) -> DataFrame:
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, texts in text_blocks(batch["doc_id"], batch["text"], _BLOCK):
                yield pd.DataFrame({
                    "doc_id": pd.array(ids, "Int64"), "node": [_digest(t) for t in texts], "buckets": band_keys(texts, params),
                })
        _memo().forget()
        release()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInPandas(
        sign, "doc_id long, node binary, buckets array<long>"
    )


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets, each as sorted hashes and counts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    whole = a[1].sum() + b[1].sum() - common
    return float(common / whole) if whole else 0.0


def _bag(text: str, words: int) -> tuple[np.ndarray, np.ndarray]:
    _, element, count = shingles([text], words)
    order = np.argsort(element)
    return element[order], count[order]


def verify(spark: SparkSession, pairs: DataFrame, texts: DataFrame, params: NearParams, n_pairs: int, budget: Budget) -> DataFrame:
    """Exact similarity of each pair (node, pivot). A pivot's members are read in chunks, each beside
    one copy of the pivot's text; rows stream through, so a task holds one pivot and one batch."""
    sizes = staged(spark, pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")), "pivots")
    chunked = join_counted(pairs, sizes, "pivot", F.xxhash64("node"), n_pairs, budget=budget).select(
        "node", "pivot", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / 64)).alias("chunk")
    )
    members = chunked.join(texts, "node").select("pivot", "chunk", F.lit(1).alias("member"), "node", "text")
    pivots = chunked.select("pivot", "chunk").distinct().join(
        texts.withColumnRenamed("node", "pivot"), "pivot"
    ).select("pivot", "chunk", F.lit(0).alias("member"), F.col("pivot").alias("node"), "text")
    rows = members.unionByName(pivots).repartition("pivot", "chunk").sortWithinPartitions("pivot", "chunk", "member")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bag, key = None, None
        for batch in batches:
            out = []
            for pivot, member, node, text in zip(batch["pivot"], batch["member"], batch["node"], batch["text"]):
                if not member:
                    if pivot != key:
                        bag, key = _bag(text, params.words), pivot
                else:
                    out.append((node, pivot, overlap(bag, _bag(text, params.words))))
            yield pd.DataFrame(out, columns=["node", "pivot", "similarity"])
        _memo().forget()
        release()

    return rows.mapInPandas(compare, "node binary, pivot binary, similarity double")


def coarse(text: str, words: int) -> tuple[int, bytes]:
    """How many shingles a text has, and how many of them fall in each cell of their hashes, 255 at most; as
    many cells as shingles, down to a power of two, so that counts in more cells can be added up to counts in fewer."""
    _, element, count = shingles([text], words)
    total = int(count.sum())
    cells = min(max(1 << (max(total, 1).bit_length() - 1), _CELLS[0]), _CELLS[1])
    held = np.bincount((element & np.uint64(cells - 1)).astype(np.int64), count, cells)
    return total, np.minimum(held, 255).astype(np.uint8).tobytes()


def _folded(cells: np.ndarray, few: int) -> np.ndarray:
    """Rows of counts in fewer cells."""
    return cells.reshape(len(cells), -1, few).sum(axis=1, dtype=np.uint16)


def possible_pairs(
    total: np.ndarray, cells: list[bytes], label: np.ndarray, part: np.ndarray, near: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different labels whose similarity may reach the threshold; of different parts, where there are two. ``near`` is each
    one's similarity to a text that all were compared with.

    What two texts share in a cell is at most the lesser count; what is above 255 is taken as shared as far as both have it.
    """
    first, second = [], []
    by_size: dict[int, np.ndarray] = {}
    for few in {len(c) for c in cells}:
        by_size[few] = np.array([i for i, c in enumerate(cells) if len(c) == few])
    held = {few: np.frombuffer(b"".join(cells[i] for i in at), np.uint8).reshape(len(at), few).astype(np.uint16) for few, at in by_size.items()}
    two = part.min() != part.max()
    for few, a in by_size.items():
        asking = np.flatnonzero(part[a] == part.min()) if two else np.arange(len(a))
        # totals of a pair differ by a quarter at most, cells by a factor of two
        for many in (few // 2, few, 2 * few) if two else (few, 2 * few):
            if many not in by_size or not len(asking):
                continue
            b, common_cells = by_size[many], min(few, many)
            left, right = _folded(held[few][asking], common_cells), _folded(held[many], common_cells)
            over_a, over_b = total[a[asking]] - left.sum(axis=1, dtype=np.int64), total[b] - right.sum(axis=1, dtype=np.int64)
            for i, at in enumerate(a[asking]):
                least, most = threshold * total[at] - 1e-6, total[at] / threshold + 1e-6
                may = (total[b] >= least) & (total[b] <= most) & (label[b] != label[at]) & (np.abs(near[b] - near[at]) <= 1 - threshold + 1e-6)
                if two:
                    may &= part[b] != part[at]
                elif many == few:
                    may &= b > at
                may = np.flatnonzero(may)
                if len(may):
                    common = np.minimum(left[i], right[may]).sum(axis=1, dtype=np.int64) + np.minimum(over_a[i], over_b[may])
                    may = may[common * (1 + threshold) >= threshold * (total[at] + total[b[may]]) - 1e-6]
                    first.append(np.full(len(may), at))
                    second.append(b[may])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *first]), np.concatenate([none, *second])


def meetings(spark: SparkSession, rows: DataFrame, threshold: float) -> DataFrame:
    """Who may have to be compared with whom: ``rows`` (bucket, node, label, near) dealt to blocks (bucket, class, i, j), a row for each block
    that a member is in, with its ``part``.

    A class with more than ``_PART`` members of a bucket is set against all other members, ``_PART`` of these at a time, itself in
    chunks of ``_CHUNK``; of two such classes the smaller counts as others. Only members within reach by ``near`` are dealt. Members of small
    classes are set against each other in parts of ``_PART``.
    """
    reach = 1 - threshold + 1e-6
    sizes = rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("own"))
    rows = staged(spark, rows.join(sizes, ["bucket", "label"]), "labelled-members")
    great, own = F.col("own") > _PART, F.col("own")
    crowds = rows.filter(great).groupBy("bucket", F.col("label").alias("crowd")).agg(
        F.count(F.lit(1)).alias("size"), F.min("near").alias("lo"), F.max("near").alias("hi")
    )
    crowds = staged(spark, crowds, "crowds")
    others = rows.join(F.broadcast(crowds) if fits_broadcast(crowds, LIMITS) else crowds, "bucket").filter(
        (F.col("label") != F.col("crowd"))
        & (~great | (F.struct(own, "label") < F.struct(F.col("size").alias("own"), F.col("crowd").alias("label"))))
        & F.col("near").between(F.col("lo") - reach, F.col("hi") + reach)
    )
    others = staged(spark, others.select("bucket", "node", "label", "near", "crowd", "size"), "strays")
    asked = others.groupBy("bucket", "crowd").agg(F.count(F.lit(1)).alias("n"), F.min("near").alias("lo"), F.max("near").alias("hi"))
    asked = staged(spark, asked, "asked")
    asked = F.broadcast(asked) if fits_broadcast(asked, LIMITS) else asked
    spread = F.xxhash64("node")
    parts, chunks = F.ceil(F.col("n") / _PART).cast("int"), F.ceil(F.col("size") / _CHUNK).cast("int")
    every = [F.col("bucket"), F.col("crowd"), F.col("i"), F.col("j"), F.col("part"), F.col("node"), F.col("label"), F.col("near")]
    strays = others.join(asked.select("bucket", "crowd", "n"), ["bucket", "crowd"]).select(
        "*", F.pmod(spread, parts).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("j"), F.lit(0).alias("part")
    ).select(*every)
    members = rows.withColumnRenamed("label", "crowd").join(asked, ["bucket", "crowd"]).filter(
        F.col("near").between(F.col("lo") - reach, F.col("hi") + reach)
    ).withColumn("size", own).withColumn("label", F.col("crowd")).select(
        "*", F.pmod(spread, chunks).cast("int").alias("j"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("i"), F.lit(1).alias("part")
    ).select(*every)
    few = rows.filter(~great)
    left = few.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("a"), F.max("label").alias("b")).filter("a <> b").select("bucket", "n")
    few = few.join(F.broadcast(left) if fits_broadcast(left, LIMITS) else left, "bucket")
    few = few.withColumn("part", F.pmod(spread, parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        "bucket", F.lit(None).cast("binary").alias("crowd"), F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "label", "near"
    )
    return strays.unionByName(members).unionByName(few)


def left_over(
    spark: SparkSession, member: DataFrame, labels: DataFrame | None, home: DataFrame, found: DataFrame, texts: DataFrame, params: NearParams,
    n_members: int, budget: Budget,
) -> DataFrame:
    """(node, pivot): all pairs of a bucket that are in different classes and may be alike. ``home`` names each bucket's first
    pivot, ``found`` has the similarity of every member to it."""
    if labels is None:
        placed = member.select("bucket", "node", F.col("node").alias("label"))
    else:
        placed = member.select("bucket", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    placed = staged(spark, placed, "placed-members")
    mixed = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    mixed = staged(spark, mixed.filter("lo <> hi").join(home, "bucket").select("bucket", "n", "pivot"), "mixed")
    rows = join_counted(placed, mixed, "bucket", F.xxhash64("node"), n_members, budget=budget).filter("n is not null")
    known = found.select("node", "pivot", F.col("similarity").alias("near")).dropDuplicates(["node", "pivot"])
    rows = rows.join(known, ["node", "pivot"], "left").select(
        "bucket", "node", "label", F.when(F.col("node") == F.col("pivot"), 1.0).otherwise(F.col("near")).alias("near")
    )
    dealt = staged(spark, meetings(spark, staged(spark, rows, "mixed-members"), params.threshold), "meetings")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = [coarse(text, params.words) for text in batch["text"]]
            yield pd.DataFrame({"node": batch["node"], "total": [t for t, _ in held], "cells": [c for _, c in held]})
        _memo().forget()
        release()

    counts = texts.join(dealt.select("node").distinct(), "node", "left_semi").mapInPandas(count, "node binary, total long, cells binary")
    key = ["bucket", "crowd", "i", "j"]
    blocks = dealt.join(staged(spark, counts, "coarse"), "node").select(*key, "part", "node", "label", "near", "total", "cells")
    blocks = blocks.repartition(*key).sortWithinPartitions(*key)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def pairs(block: list[tuple]) -> list[tuple[bytes, bytes]]:
            part, node, label, near, total, cells = zip(*block)
            code = {x: k for k, x in enumerate(set(label))}
            if len(code) < 2 or (at[1] is not None or at[2] != at[3]) and len(set(part)) < 2:
                return []
            one, two = possible_pairs(
                np.array(total), list(cells), np.array([code[x] for x in label]), np.array(part), np.array(near), params.threshold
            )
            return [(min(node[a], node[b]), max(node[a], node[b])) for a, b in zip(one, two)]

        at, block = None, []
        for batch in batches:
            out: set[tuple[bytes, bytes]] = set()
            for bucket, crowd, i, j, *row in batch.itertuples(index=False, name=None):
                if (bucket, crowd, i, j) != at:
                    if len(block) > 1:
                        out.update(pairs(block))
                    at, block = (bucket, crowd, i, j), []
                block.append(tuple(row))
            yield pd.DataFrame(list(out), columns=["node", "pivot"])
        if len(block) > 1:
            yield pd.DataFrame(pairs(block), columns=["node", "pivot"])
        release()

    return blocks.mapInPandas(compare, "node binary, pivot binary").distinct()


def components(spark: SparkSession, links: DataFrame, budget: Budget) -> DataFrame:
    """(node, label): the least node of each node's connected component. Labels travel along links and then
    to the label's own label, until nothing changes; each step is written to shared storage."""
    both = staged(spark, links.select("node", "pivot").union(links.select("pivot", "node")).toDF("a", "b"), "links")
    total = both.count()
    sizes = staged(spark, both.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "degrees")
    labels = staged(
        spark,
        both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")),
        "labels",
    )
    while True:
        at = sizes.join(labels.withColumnRenamed("node", "a"), "a")
        heard = join_counted(both, at, "a", F.xxhash64("b"), total, budget=budget).groupBy("b").agg(F.min("label").alias("heard"))
        heard = labels.join(heard.withColumnRenamed("b", "node"), "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", "heard").alias("label")
        )
        heard = staged(spark, heard, "labels")
        followed = heard.groupBy("label").agg(F.count(F.lit(1)).alias("n")).join(
            heard.select(F.col("node").alias("label"), F.col("label").alias("next")), "label"
        )
        jumped = join_counted(heard, staged(spark, followed, "labels"), "label", F.xxhash64("node"), total, budget=budget).select(
            "node", "old", F.least("label", F.coalesce("next", "label")).alias("label")
        )
        jumped = staged(spark, jumped, "labels")
        labels = jumped.select("node", "label")
        if not jumped.filter("label <> old").limit(1).count():
            return labels


def classes(spark: SparkSession, docs: DataFrame, params: NearParams = NearParams()) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class), and links: how many verified links its text has, to pivots or, for
    a pivot, to members, and to texts whose class was another one until then. Equal texts are always one class. A null text counts as empty; a text without
    words is like its equals only. Every input row gives one row, repeated rows too; an empty table gives none.
    """
    budget = Budget()
    signed = staged(spark, signatures(docs, params), "signatures")
    total = signed.count()
    rows = signed.select(F.explode("buckets").alias("bucket"), "node")
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("a"), F.max("node").alias("b"))
    shared = staged(spark, sizes.filter("a <> b").select("bucket", "n"), "buckets")
    member = join_counted(rows, shared, "bucket", F.xxhash64("node"), total * params.bands, budget=budget).filter("n is not null")
    member = staged(spark, member.distinct(), "members")
    n_members = member.count()
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    found = home = labels = None
    if n_members:
        firsts = nodes.join(member.select("node").distinct(), "node", "left_semi")
        # texts are fetched by id: one row of each text that shares a bucket
        wanted = firsts.select("node", "doc_id")
        texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        texts = wanted.join(texts, wanted["doc_id"].eqNullSafe(texts["doc_id"])).select("node", "text")
        texts = texts.mapInPandas(_own_text, "node binary, text string")
        texts = staged(spark, texts, "texts").dropDuplicates(["node"])
        central = member.groupBy("node").agg(F.sum("n").alias("central"))
        member = staged(spark, member.join(central, "node"), "members")
        rest = member.withColumn("label", F.col("node"))
        while True:
            pivots = rest.groupBy("bucket").agg(
                F.max(F.struct("central", "node", "label")).alias("p"), F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")
            ).filter("lo <> hi").select("bucket", "n", F.col("p.node").alias("pivot"), F.col("p.label").alias("pivot_label"))
            pivots = staged(spark, pivots, "pivots")
            home = pivots.select("bucket", "pivot") if home is None else home
            beside = staged(
                spark,
                join_counted(rest.drop("n"), pivots, "bucket", F.xxhash64("node"), n_members, budget=budget).filter("pivot is not null and label <> pivot_label"),
                "beside",
            )
            pairs = beside.select("node", "pivot").distinct()
            if found is not None:
                pairs = pairs.join(found, ["node", "pivot"], "left_anti")
            pairs = staged(spark, pairs, "pairs")
            n_pairs = pairs.count()
            fresh = staged(spark, verify(spark, pairs, texts, params, n_pairs, budget), "similar") if n_pairs else None
            if fresh is not None:
                found = fresh if found is None else found.unionByName(fresh)
            linked = fresh is not None and fresh.filter(F.col("similarity") >= params.threshold).limit(1).count()
            if not linked:
                break
            labels = components(spark, found.filter(F.col("similarity") >= params.threshold), budget)
            # who is not yet in the class of a pivot of its bucket stays and elects another
            label_of = beside.select("node", "bucket", "central", "pivot").join(
                labels.withColumnRenamed("label", "now"), "node", "left"
            ).withColumn("label", F.coalesce("now", "node")).drop("now")
            theirs = labels.select(F.col("node").alias("pivot"), F.col("label").alias("theirs"))
            by_pivot = label_of.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).join(theirs, "pivot", "left")
            rest = join_counted(label_of, staged(spark, by_pivot, "pivots"), "pivot", F.xxhash64("node", "bucket"), n_members, budget=budget)
            rest = staged(
                spark, rest.filter(F.col("label") != F.coalesce("theirs", "pivot")).select("bucket", "node", "n", "central", "label"), "rest"
            )
        pairs = left_over(spark, member, labels, home, found, texts, params, n_members, budget)
        seen = found.select("node", "pivot").union(found.select("pivot", "node"))
        pairs = staged(spark, pairs.join(seen.toDF("node", "pivot"), ["node", "pivot"], "left_anti"), "pairs")
        n_pairs = pairs.count()
        if n_pairs:
            fresh = staged(spark, verify(spark, pairs, texts, params, n_pairs, budget), "similar")
            found = found.unionByName(fresh)
            if fresh.filter(F.col("similarity") >= params.threshold).limit(1).count():
                labels = components(spark, found.filter(F.col("similarity") >= params.threshold), budget)
    known = nodes
    if labels is None:
        known = known.select("node", F.col("doc_id").alias("class_id"), F.col("copies").alias("n"), F.lit(0).cast("long").alias("links"))
    else:
        links = found.filter(F.col("similarity") >= params.threshold)
        degree = links.select("node").unionAll(links.select("pivot")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
        placed = staged(
            spark,
            nodes.join(labels, "node", "left").join(degree, "node", "left").select(
                "node", "doc_id", "copies", F.coalesce("label", "node").alias("label"), F.coalesce("links", F.lit(0)).cast("long").alias("links")
            ),
            "placed",
        )
        least = placed.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n"))
        known = join_counted(placed, staged(spark, least, "classes"), "label", F.xxhash64("node"), total, budget=budget).select(
            "node", "class_id", F.col("copies").alias("n"), "links"
        )
    out = join_counted(signed.select("doc_id", "node"), staged(spark, known, "known"), "node", F.xxhash64("doc_id"), total, budget=budget)
    return out.select("doc_id", "class_id", "links")


def _own_text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Where several rows have one id: those whose text is the node's."""
    for batch in batches:
        yield batch[[n == _digest(t) for n, t in zip(batch["node"], batch["text"])]]


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document."""
    return classes(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class the document with the least id stays; rows repeating that id stay together."""
    marked = classes(spark, docs).filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select("doc_id").distinct()
    left = docs.alias("d")
    kept = marked.withColumnRenamed("doc_id", "_kept_id")
    return left.join(kept, F.col("d.doc_id").eqNullSafe(F.col("_kept_id")), "left_semi")
