"""Quality rules: document statistics, and gradient-boosted trees over them.

Trees are grown on a bounded sample of labelled documents, with a falling (or rising) constraint on chosen
statistics, then flattened into arrays of nodes, so a batch of documents walks all trees at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm.common import table, text_blocks

_words = re.compile(r"[^\x20\x09-\x0D]+").findall
_BLANK, _SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics, and whether the score must fall (-1) as they rise.
FEATURES: dict[str, int] = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "distinct_share": 0,
    "upper_share": 0, "digit_share": 0, "mark_share": 0, "words_per_line": 0, "longest_word": 0,
}


@dataclass(frozen=True)
class QualityParams:
    """``sample`` bounds the labelled documents that trees are grown on (about so many, by a hash of
    their id); a document is kept from a score of ``least`` on."""

    sample: int = 20_000
    trees: int = 60
    depth: int = 3
    bins: int = 48
    rate: float = 0.2
    smallest: int = 8
    ridge: float = 1.0
    least: float = 0.5


def repeated(words: list[str], size: int = 5) -> tuple[int, int]:
    """How many words lie in a window of ``size`` words that occurs more than once, and how many different
    words there are. Windows get exact numbers by pairing the numbers of shorter ones."""
    number, distinct = pd.factorize(np.array(words, dtype=object)) if words else (np.zeros(0, np.int64), [])
    if len(words) <= size:
        return 0, len(distinct)

    def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * np.int64(b.max() + 1) + b, return_inverse=True)[1]

    number = number.astype(np.int64)
    whole = number
    for k in range(1, size):
        whole = paired(whole[:-1], number[k:])
    often = np.bincount(whole)[whole] > 1
    at = np.flatnonzero(often)
    if not len(at):
        return 0, len(distinct)
    cover = np.zeros(len(words) + 1, np.int64)
    cover[at] += 1
    cover[at + size] -= 1
    return int(np.count_nonzero(np.cumsum(cover))), len(distinct)


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The counts of ``COUNTS`` and the ``FEATURES`` of a text."""
    words = _words(text)
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in _BLANK)
    symbols = sum(text.count(c) for c in _SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    dup = len(lines) - len(set(lines))
    repeat, distinct = repeated(words)
    seen = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    upper, digits = int(seen[65:91].sum()), int(seen[48:58].sum())
    marks = int(seen[[33, 34, 44, 46, 58, 59, 63]].sum())
    some = max(n, 1)
    return [n, chars, symbols, dup, repeat], [
        float(np.log1p(n)), chars / some, symbols / some, dup / max(len(lines), 1), repeat / some, distinct / some,
        upper / max(chars, 1), digits / max(chars, 1), marks / some, n / max(len(lines), 1), float(max(map(len, words), default=0)),
    ]


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees in one list; a leaf points to itself. ``roots`` has the first node of each tree."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    depth: int = 0
    base: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for each row of statistics."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(axis=1))))


def grow(x: np.ndarray, y: np.ndarray, params: QualityParams = QualityParams(), signs: tuple[int, ...] = tuple(FEATURES.values())) -> Trees:
    """Logistic boosting over histograms. A split on a constrained statistic is taken only if its sides' values are in
    order, and both subtrees stay on their side of the middle, so the whole score is monotonic."""
    if not len(y):
        return Trees()
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, params.bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    raw = np.full(len(y), base)
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []

    def build(rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float, depth: int) -> int:
        me = len(nodes)
        value = float(np.clip(g[rows].sum() / (h[rows].sum() + params.ridge), low, high))
        nodes.append([0, 0.0, me, me, params.rate * value])
        best = (1e-6, None)
        if depth and len(rows) >= 2 * params.smallest:
            g_all, h_all = g[rows].sum(), h[rows].sum()
            for f, e in enumerate(edges):
                b = binned[rows, f]
                gs, hs, ns = (np.cumsum(np.bincount(b, w, len(e) + 1))[:-1] for w in (g[rows], h[rows], None))
                left, right = gs / (hs + params.ridge), (g_all - gs) / (h_all - hs + params.ridge)
                gain = gs * left + (g_all - gs) * right - g_all**2 / (h_all + params.ridge)
                gain[(ns < params.smallest) | (len(rows) - ns < params.smallest)] = 0
                if signs[f]:
                    gain[(np.clip(right, low, high) - np.clip(left, low, high)) * signs[f] < 0] = 0
                if len(gain) and gain.max() > best[0]:
                    at = int(gain.argmax())
                    best = (gain[at], (f, at, np.clip(left[at], low, high), np.clip(right[at], low, high)))
        if best[1]:
            f, at, lv, rv = best[1]
            middle = (lv + rv) / 2
            sides = [(low, high), (low, high)]
            if signs[f] > 0:
                sides = [(low, middle), (middle, high)]
            elif signs[f] < 0:
                sides = [(middle, high), (low, middle)]
            goes = binned[rows, f] <= at
            nodes[me][:2] = [f, float(edges[f][at])]
            nodes[me][2] = build(rows[goes], g, h, *sides[0], depth - 1)
            nodes[me][3] = build(rows[~goes], g, h, *sides[1], depth - 1)
        return me

    for _ in range(params.trees):
        p = 1 / (1 + np.exp(-raw))
        roots.append(build(np.arange(len(y)), y - p, p * (1 - p), -np.inf, np.inf, params.depth))
        grown = Trees(*(np.array(c, t) for c, t in zip(zip(*nodes), (np.int64, float, np.int64, np.int64, float))), np.array(roots[-1:]), params.depth)
        raw += np.log(s := grown.score(x)) - np.log1p(-s)
    return Trees(*(np.array(c, t) for c, t in zip(zip(*nodes), (np.int64, float, np.int64, np.int64, float))), np.array(roots), params.depth, base)


def learn(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> Trees:
    """Trees from the documents that ``labels`` (doc_id, quality 0 or 1) covers; rows with a null teach nothing."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).select("doc_id", "quality")
    share = min(1.0, params.sample / max(1, usable.count()))
    sample = usable.filter(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)) < share * (1 << 20))
    taught = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(sample), "doc_id")

    def stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [statistics(t)[1] for t in batch["text"]]
            yield pd.DataFrame(rows, columns=list(FEATURES)).assign(doc_id=batch["doc_id"].to_numpy(), y=batch["quality"].to_numpy(float))

    schema = ", ".join(f"{f} double" for f in FEATURES) + ", doc_id long, y double"
    rows = taught.select("doc_id", "text", "quality").mapInPandas(stats, schema).toPandas()
    rows = rows.sort_values(["doc_id", "y", *FEATURES])  # the same trees from any order of rows
    return grow(rows[list(FEATURES)].to_numpy(float).reshape(-1, len(FEATURES)), rows["y"].to_numpy(float), params)


def judge(spark: SparkSession, docs: DataFrame, trees: Trees, params: QualityParams = QualityParams()) -> DataFrame:
    """doc_id, the counts, base_failed, kept and score. A null text has no words and fails; every row gives one. Without
    any label to learn from, the base rules alone decide."""
    sent = spark.sparkContext.broadcast(trees)
    names = ["doc_id", *COUNTS, "base_failed", "kept", "score"]

    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, texts in text_blocks(batch["doc_id"], batch["text"], 1 << 22):
                found = [statistics(t) for t in texts]
                counts = np.array([c for c, _ in found], np.int64)
                failed = (counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0])
                score = sent.value.score(np.array([f for _, f in found], float)) if len(sent.value.roots) else np.ones(len(ids))
                yield pd.DataFrame(
                    dict(zip(names, [pd.array(ids, "Int64"), *counts.T, failed, ~failed & (score >= params.least), score]))
                )

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, score double"
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInPandas(rate, schema)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for every document, trees grown on the labels."""
    docs = table(spark, sf_dir, "documents")
    return judge(spark, docs, learn(docs, table(spark, sf_dir, "labels")))
