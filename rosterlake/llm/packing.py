"""Packing documents into sequences by bin completion.

Only lengths matter to a packing, and there are at most ``capacity`` of them. Spark tokenises and
counts pieces by length; branch-and-bound over that histogram gives patterns with multiplicities; each
piece then finds its place from its rank among the pieces of its length. No group grows with a length's share.
"""

from __future__ import annotations

import os
import random
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import release, table
from rosterlake.llm.words import Memo, split_batch, text_slices, vocabulary_path
from rosterlake.session import staged

Pattern = tuple[tuple[int, int], ...]  # (length, how many), longest first
END_ID = 1
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_NAMES, _TYPES = ["doc_id", "piece", "start", "length", "ids_crc32"], [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins: total length, or for some k the pieces above capacity - k,
    those above half, and what pieces of k or more do not fit beside them."""
    lengths = np.array(sorted(counts), np.int64)
    if not len(lengths):
        return 0
    number = np.array([counts[x] for x in lengths.tolist()], dtype=object)
    best = -(-int((lengths.astype(object) * number).sum()) // capacity)
    mass = lengths.astype(object) * number
    for k in [0, *lengths[lengths * 2 <= capacity].tolist()]:
        alone, large = lengths > capacity - k, (lengths <= capacity - k) & (lengths * 2 > capacity)
        small = (lengths * 2 <= capacity) & (lengths >= max(k, 1))
        room = int(number[large].sum()) * capacity - int(mass[large].sum())
        best = max(best, int(number[alone].sum()) + int(number[large].sum()) + max(0, -(-(int(mass[small].sum()) - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, Pattern]]:
    """Best-fit decreasing; bins alike are handled together."""
    room: dict[int, list[list]] = {}  # free room: [bins, contents]
    free = np.zeros(capacity + 1, bool)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fits = np.flatnonzero(free[length:])
            if len(fits):
                r = int(fits[0]) + length
                group = room[r].pop()
                if not room[r]:
                    free[r] = False
                bins, held = group
            else:
                r, held = capacity, ()
                bins = -(-left // (capacity // length))
            deep = min(r // length, max(1, left // bins))
            used = min(bins, left // deep)
            if used < bins:
                if r < capacity or held:
                    room.setdefault(r, []).append([bins - used, held])
                    free[r] = True
            left -= used * deep
            rest = r - deep * length
            room.setdefault(rest, []).append([used, held + ((length, deep),)])
            free[rest] = rest > 0
    return [(bins, held) for groups in room.values() for bins, held in groups]


def _two(lengths: np.ndarray, number: np.ndarray, worth: np.ndarray, room: int) -> tuple[float, tuple[int, ...]]:
    """At most two pieces that fit the room, worth most together; of equals the pair with the longest piece."""
    n = int(np.searchsorted(lengths, room, "right"))
    if not n:
        return 0.0, ()
    lengths, number, worth = lengths[:n], number[:n], worth[:n]
    best, held = float(worth[-1]), (int(lengths[-1]),)
    mine = np.arange(n)
    other = np.searchsorted(lengths, room - lengths, "right") - 1
    other = np.where(other >= mine, np.where(number > 1, mine, mine - 1), other)  # no longer than the first
    both = np.where(other >= 0, worth + worth[other], -1.0)
    k = n - 1 - int(both[::-1].argmax())
    if both[k] > best:
        best, held = float(both[k]), (int(lengths[k]), int(lengths[other[k]]))
    return best, held


def fullest(counts: dict[int, int], capacity: int, power: float) -> list[tuple[int, Pattern]]:
    """Bin by bin around the largest piece left: the longest pieces that fit in turn, the last two chosen to be worth most. A piece is worth
    its length to a ``power``: 1 fills each bin as well as it can, more keeps short pieces for bins that hold many."""
    lengths = np.array(sorted(counts), np.int64)
    number = np.array([counts[x] for x in lengths.tolist()], np.int64)
    worth, out = (lengths / capacity) ** power, []
    while True:
        some = number > 0
        lengths, number, worth = lengths[some], number[some], worth[some]
        if not len(lengths):
            return out
        free = number.copy()
        free[-1] -= 1
        held, room, got = [int(lengths[-1])], capacity - int(lengths[-1]), 0.0
        best, most = tuple(held), -1.0
        while True:
            there = free > 0
            value, more = _two(lengths[there], free[there], worth[there], room)
            if got + value > most + 1e-12:
                best, most = (*held, *more), got + value
            fits = np.flatnonzero(there[: np.searchsorted(lengths, room, "right")])
            if not len(fits):
                break
            k = int(fits[-1])
            free[k] -= 1
            held.append(int(lengths[k]))
            room, got = room - int(lengths[k]), got + float(worth[k])
        need = Counter(best)
        at = np.searchsorted(lengths, list(need))
        times = int((number[at] // list(need.values())).min())
        number[at] -= times * np.array(list(need.values()))
        out.append((times, tuple(sorted(need.items(), reverse=True))))


def _fillings(counts: dict[int, int], lengths: list[int], room: int, width: int | None, steps: int | None) -> tuple[list[Pattern], bool]:
    """Fillings of ``room`` beside a bin's largest piece, fullest first, then fewest pieces; and whether these are all that
    matter. One is left out if it is dominated: a piece left over could replace one of its pieces, be longer, and still fit. If a
    single piece fills the room exactly, it dominates all others."""
    if counts.get(room, 0):
        return [((room, 1),)], True
    found: list[tuple[int, int, Pattern]] = []
    stack: list[tuple[int, int, Pattern]] = [(0, room, ())]
    usable = [x for x in lengths if x <= room and counts[x]]
    full, done = 0, True
    while stack:
        if steps is not None:
            if not steps:
                done = False
                break
            steps -= 1
        i, left, held = stack.pop()
        while i < len(usable) and usable[i] > left:
            i += 1
        if i == len(usable):
            found.append((left, sum(k for _, k in held), held))
            full += not left
            if width is not None and full >= width:
                done = not stack
                break
            continue
        x = usable[i]
        for k in range(min(left // x, counts[x]) + 1):  # the most of x on top of the stack
            stack.append((i + 1, left - k * x, held + ((x, k),) if k else held))
    found.sort(key=lambda f: (f[0], f[1]))
    out = []
    for left, _, held in found:
        mine = dict(held)
        if left and any(any(counts.get(z, 0) > mine.get(z, 0) for z in range(y + 1, y + left + 1)) for y in mine):
            continue
        if width is not None and len(out) == width:
            done = False
            break
        out.append(held)
    return out or [found[0][2] if found else ()], done


@dataclass(frozen=True)
class SearchLimits:
    """What a search may spend: nodes, fillings tried at a node, steps to enumerate them. None of each: as much as it takes, and
    the result is a best one. ``repairs``: how often some bins are searched anew by themselves where the bound was not met. Shapes are
    powers for ``fullest``, each giving an incumbent."""

    nodes: int | None = 2000
    width: int | None = 3
    steps: int | None = 300
    repairs: int = 40
    shapes: tuple[float, ...] = (1.0, 1.03, 1.06, 1.1, 1.15, 1.2, 1.3, 1.5, 1.7, 1.85, 2.0, 2.15, 2.3, 2.6, 3.0)


NO_LIMITS = SearchLimits(None, None, None, 0)
_REPAIR_BINS, _REPAIR = 30, SearchLimits(200, 4, 400, 0, (1.0, 1.05, 1.1, 1.2, 2.0))


@dataclass(frozen=True)
class Packing:
    """``patterns`` with how often each is used; how many ``bins`` that is, how many any packing has at ``least``, and whether
    the search went through to its end, so that no packing has fewer."""

    patterns: list[tuple[int, Pattern]]
    bins: int
    least: int
    proven: bool


def bin_completion(counts: dict[int, int], capacity: int, limits: SearchLimits = SearchLimits()) -> Packing:
    """Patterns and how often each is used, together holding every piece of ``counts`` once.

    Best-fit decreasing and the ``fullest`` fillings are the first incumbents. Then depth first: the largest piece left gets its undominated
    fillings in turn, and a branch ends when its waste exceeds what a better packing than the incumbent can have. What is held
    is the choices on the way down, not their histograms: going back puts pieces back. With limits, a filling is used as often as pieces allow
    at once, and the search may be cut; it always ends with a full packing.
    """
    counts = {x: n for x, n in counts.items() if n}
    if not counts:
        return Packing([], 0, 0, True)
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError("lengths must lie between 1 and the capacity")
    least, total = lower_bound(counts, capacity), sum(x * n for x, n in counts.items())
    incumbent = best_fit(counts, capacity)
    used = sum(n for n, _ in incumbent)
    for power in limits.shapes:
        if used > least:
            other = fullest(counts, capacity, power)
            if sum(n for n, _ in other) < used:
                incumbent, used = other, sum(n for n, _ in other)
    left, lengths = dict(counts), sorted(counts, reverse=True)
    bins, waste, nodes, complete = 0, 0, limits.nodes, True
    # each entry: the place of its largest piece, fillings to try, and the choice that stands (times and needs)
    stack: list[list] = []
    at, down = 0, True
    while used > least:
        if down:
            while at < len(lengths) and not left[lengths[at]]:
                at += 1
            if at == len(lengths):
                if bins < used:
                    incumbent, used = [(e[2][0], tuple(sorted(e[2][1].items(), reverse=True))) for e in stack], bins
            elif bins + 1 < used and waste <= (used - 1) * capacity - total:
                if nodes is not None:
                    if not nodes:
                        complete = False
                        break
                    nodes -= 1
                first = lengths[at]
                left[first] -= 1
                fillings, all_ = _fillings(left, lengths[at:], capacity - first, limits.width, limits.steps)
                left[first] += 1
                complete &= all_
                stack.append([at, fillings[::-1], None])
        if not stack:
            break
        place, fillings, choice = stack[-1]
        if choice:
            times, need = choice
            for x, k in need.items():
                left[x] += times * k
            bins -= times
            waste -= times * (capacity - sum(x * k for x, k in need.items()))
            stack[-1][2] = None
        if not fillings:
            stack.pop()
            down = False
            continue
        need = Counter({lengths[place]: 1})
        for x, k in fillings.pop():
            need[x] += k
        times = 1 if limits.nodes is None else min(left[x] // k for x, k in need.items())
        complete &= times == 1
        for x, k in need.items():
            left[x] -= times * k
        bins += times
        waste += times * (capacity - sum(x * k for x, k in need.items()))
        stack[-1][2] = (times, need)
        at, down = place, True
    return _repaired(Packing(incumbent, used, least, used == least or complete), capacity, limits.repairs)


def _repaired(packing: Packing, capacity: int, rounds: int) -> Packing:
    """The emptiest bins and some others, the same in every run, searched anew by themselves; again and again."""
    if packing.proven or not rounds:
        return packing
    patterns, chosen = Counter(), random.Random(0)
    for times, pattern in packing.patterns:
        patterns[pattern] += times
    used = packing.bins
    for _ in range(rounds):
        if used <= packing.least:
            break
        by_content = sorted(patterns, key=lambda p: (sum(x * k for x, k in p), p))
        some: Counter = Counter()
        for pattern in by_content:
            some[pattern] = min(patterns[pattern], _REPAIR_BINS // 2 - some.total())
            if some.total() == _REPAIR_BINS // 2:
                break
        for pattern in chosen.sample(by_content, min(len(by_content), _REPAIR_BINS // 2)):
            some[pattern] += patterns[pattern] > some[pattern]
        counts: Counter = Counter()
        for pattern, times in some.items():
            for x, k in pattern:
                counts[x] += times * k
        anew = bin_completion(counts, capacity, _REPAIR)
        if anew.bins <= some.total():  # as many do as well: the next round starts from other bins
            used -= some.total() - anew.bins
            patterns -= some
            for times, pattern in anew.patterns:
                patterns[pattern] += times
    return Packing([(times, pattern) for pattern, times in sorted(patterns.items()) if times], used, packing.least, used == packing.least)


#: A word of Latin letters and what ASCII marks follow it: the vocabulary splits there, and lowers each letter alone.
_PLAIN = (
    "^(?P<word>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)"
    "(?P<marks>[!-&(-/:-@\\[-`{-~]*)$"
)


class Encoder:
    """Token ids of chunks without white space. Most chunks are a plain word and marks: only those parts, far fewer, are
    encoded, many at a time as one text that is cut after each part's last token."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.parts = Memo(self._encode_parts, 200_000)
        self.others = Memo(self._encode_others, 20_000)

    def _encode_parts(self, some: list[str]) -> list[bytes]:
        ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
        ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
        if len(ends) != len(some):
            raise ValueError("a part without a last token")
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _encode_others(self, some: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(some, add_special_tokens=False)]

    def encode(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all chunks in turn, and how many each has."""
        split = pc.extract_regex(chunks, _PLAIN)
        plain = np.asarray(split.is_valid())
        words = pc.utf8_lower(split.filter(split.is_valid()).field("word"))
        marks = split.filter(split.is_valid()).field("marks")
        held = []
        first = np.zeros(len(chunks), np.int64)  # of a chunk's parts; none is number 0
        second = np.zeros(len(chunks), np.int64)
        at = 1
        for kind, memo, texts, where in (
            (first, self.parts, words, plain), (second, self.parts, marks, plain),
            (first, self.others, chunks.filter(split.is_null()), ~plain),
        ):
            coded = texts.dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            known = [t for t in distinct if t]
            memo.learn(known)
            held += [memo[t] if t else b"" for t in distinct]
            kind[where] = np.asarray(coded.indices, np.int64) + at
            at += len(distinct)
        ids = np.frombuffer(b"".join(held), "<u4")
        sizes = np.array([0, *(len(h) // 4 for h in held)], np.int64)
        parts = np.stack((first, second), axis=1).reshape(-1)
        return gathered(ids, sizes, parts), (sizes[first] + sizes[second])


def gathered(values: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Of consecutive runs with these ``sizes``, the wanted ones in turn."""
    begins, lengths = (np.cumsum(sizes) - sizes)[wanted], sizes[wanted]
    ends = np.cumsum(lengths)
    return values[np.repeat(begins - ends + lengths, lengths) + np.arange(int(lengths.sum()))]


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, capacity: int, path: str) -> DataFrame:
    """The documents' token ids, each followed by id 1, cut where longer than ``capacity``. A null text is empty."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, end = _encoder(path), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for part in text_slices(batch):
                at, words, distinct = split_batch(part.column("text"))
                ids, sizes = encoder.encode(distinct)
                ids, ends = gathered(ids, sizes, at), np.cumsum(sizes[at])
                token_end = np.concatenate(([0], ends))[np.cumsum(words)]
                rows: list[tuple] = []
                start = 0
                for doc_id, stop in zip(part.column("doc_id").to_pylist(), token_end.tolist()):
                    own = memoryview(ids[start:stop].tobytes() + end)
                    for piece, first in enumerate(range(0, len(own), capacity * 4)):
                        some = own[first : first + capacity * 4]
                        rows.append((doc_id, piece, first // 4, len(some) // 4, zlib.crc32(some)))
                    start = stop
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)
        encoder.parts.forget()
        encoder.others.forget()
        release()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def pack(spark: SparkSession, docs: DataFrame, capacity: int = 4096, path: str | None = None, limits: SearchLimits = SearchLimits()) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``; sequences have no gaps. ``over_bound``, the same in all rows, says how
    many more sequences there are than the lower bound allows: 0 is a best packing, more is one that may be best, or a search that was cut
    (``limits``; ``NO_LIMITS`` searches to the end).

    Rows that repeat are packed each for itself. An empty table gives no rows. Reaches the driver: how
    many pieces there are of each length, and of each part of a length (at most twice ``capacity`` numbers, plus one for each length).
    """
    cut = staged(spark, pieces(docs, capacity, path or vocabulary_path()), "pieces")
    counts = {int(r[0]): int(r[1]) for r in cut.groupBy("length").agg(F.count(F.lit(1))).collect()}
    # pieces of one length are ranked in parts, so that a length with most of the pieces is no single group
    most = max(64, sum(counts.values()) // capacity)
    ways = {x: -(-n // most) for x, n in counts.items()}
    first, at = {}, 0
    for x in sorted(counts):
        first[x], at = at, at + ways[x]
    by_length = np.zeros((2, capacity + 1), np.int64)
    for x in counts:
        by_length[:, x] = first[x], ways[x]
    sent = spark.sparkContext.broadcast(by_length)

    @F.pandas_udf("long")
    def part_of(length: pd.Series, spread: pd.Series) -> pd.Series:
        start, n = sent.value[:, length.to_numpy()]
        return pd.Series(start + spread.to_numpy() % np.maximum(n, 1))

    spread = F.xxhash64("doc_id", "piece", "ids_crc32").bitwiseAND(F.lit((1 << 62) - 1))
    parted = cut.withColumn("part", part_of("length", spread))
    part_sizes = np.zeros(at + 1, np.int64)
    for r in parted.groupBy("part").agg(F.count(F.lit(1))).collect():
        part_sizes[r[0] + 1] = r[1]
    packing = bin_completion(counts, capacity, limits)
    place = spark.sparkContext.broadcast((np.cumsum(part_sizes), *_layout(counts, packing)))
    ranked = parted.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy("doc_id", "piece", "start", "ids_crc32")))

    def seat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before, starts, repeat, sequence, offset = place.value
        for batch in batches:
            key = before[batch["part"].to_numpy()] + batch["rank"].to_numpy() - 1
            segment = np.searchsorted(starts, key, "right") - 1
            along = key - starts[segment]
            batch = batch.drop(columns=["part", "rank"]).astype({"doc_id": "Int64"})
            yield batch.assign(
                sequence_id=sequence[segment] + along // repeat[segment],
                offset=offset[segment] + along % repeat[segment] * batch["length"].to_numpy(),
            )

    seated = ranked.mapInPandas(seat, PIECES + ", sequence_id long, offset long")
    return seated.withColumn("over_bound", F.lit(packing.bins - packing.least).cast("long"))


def _layout(counts: dict[int, int], packing: Packing) -> tuple[np.ndarray, ...]:
    """Pieces ordered by length, in segments that one pattern takes: first piece, pieces in each
    sequence, first sequence, place in the sequence."""
    next_piece, at = {}, 0
    for x in sorted(counts):
        next_piece[x], at = at, at + counts[x]
    segments, sequence = [], 0
    for times, pattern in packing.patterns:
        offset = 0
        for x, k in pattern:
            segments.append((next_piece[x], k, sequence, offset))
            next_piece[x] += times * k
            offset += k * x
        sequence += times
    segments.sort()
    return tuple(np.array(c, np.int64) for c in zip(*segments)) if segments else (np.zeros(0, np.int64),) * 4


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packed pieces of all documents, copies of a document each for itself."""
    return pack(spark, docs)
