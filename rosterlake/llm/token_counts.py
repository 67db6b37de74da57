"""Greedy word-piece counts with a linear longest-match automaton.

A trie holds the vocabulary. Each node that is no token knows where matching goes on when the
next symbol fails (its failure link) and how many tokens are complete by then (its popped count), so a
word is read once, without building or trying pieces. Words of a batch move through the automaton together.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rosterlake.llm.common import table
from rosterlake.llm.words import Memo, pieces_of_vocabulary, split_batch, text_slices, vocabulary_path, words_of

_SYMBOLS = 512


class LongestMatch:
    """Symbols are bytes, plus 256 at the end of a word. Every symbol must itself be a token:
    then any word can be read to its end."""

    def __init__(self, tokens: list[tuple[int, ...]]):
        children: list[dict[int, int]] = [{}]
        depth_symbols: list[tuple[int, int]] = [(0, -1)]  # parent and symbol of each node
        is_token = [False]
        for token in tokens:
            node = 0
            for symbol in token:
                if symbol not in children[node]:
                    children[node][symbol] = len(children)
                    children.append({})
                    depth_symbols.append((node, symbol))
                    is_token.append(False)
                node = children[node][symbol]
            is_token[node] = True
        if len([s for s in children[0] if is_token[children[0][s]]]) < _SYMBOLS:
            raise ValueError("the vocabulary lacks a single symbol")
        n = len(children)
        self.link, self.popped = np.zeros(n, np.int64), np.zeros(n, np.int64)
        level = list(children[0].values())
        link, popped = [0] * n, [0] * n
        while level:  # by depth, so that links of shorter prefixes are known
            for node in level:
                if is_token[node]:
                    link[node], popped[node] = 0, 1
                    continue
                parent, symbol = depth_symbols[node]
                at, count = link[parent], popped[parent]
                while symbol not in children[at]:
                    at, count = link[at], count + popped[at]
                link[node], popped[node] = children[at][symbol], count
            level = [child for node in level for child in children[node].values()]
        self.link[:], self.popped[:] = link, popped
        edges = sorted((node * _SYMBOLS + symbol, child) for node in range(n) for symbol, child in children[node].items())
        self.edge = np.array([e for e, _ in edges], np.int64)
        self.child = np.array([c for _, c in edges], np.int64)

    def count(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word; an empty word has none."""
        sizes = np.array([len(w) for w in words], np.int64)
        totals = np.zeros(len(words), np.int64)
        if not sizes.sum():
            return totals
        symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        ends = np.cumsum(sizes)
        symbols[ends[sizes > 0] - 1] += 256
        at, end = ends - sizes, ends
        node = np.zeros(len(words), np.int64)
        live = np.flatnonzero(sizes)
        while len(live):
            key = node[live] * _SYMBOLS + symbols[at[live]]
            place = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            found = self.edge[place] == key
            on, back = live[found], live[~found]
            node[on] = self.child[place[found]]
            at[on] += 1
            totals[back] += self.popped[node[back]]
            node[back] = self.link[node[back]]
            live = np.concatenate((back, on[at[on] < end[on]]))
        rest = np.flatnonzero(node)
        while len(rest):  # the tokens that are still held at the end
            totals[rest] += self.popped[node[rest]]
            node[rest] = self.link[node[rest]]
            rest = rest[node[rest] > 0]
        return totals


@lru_cache(maxsize=1)
def _counter(path: str) -> Memo:
    automaton = LongestMatch(pieces_of_vocabulary(path))

    def many(some: list[str]) -> list[tuple[int, int]]:
        words = [words_of(c) for c in some]
        flat = automaton.count([w for ws in words for w in ws])
        ends = np.cumsum([len(ws) for ws in words])
        sums = np.concatenate(([0], np.cumsum(flat)))
        return [(int(len(ws)), int(sums[e] - sums[e - len(ws)])) for ws, e in zip(words, ends)]

    return Memo(many)


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_words and n_tokens of each text: words as the vocabulary's own splitting has
    them, tokens by greedy longest match. A null or empty text has 0 of both; every row gives one."""
    place = path or vocabulary_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _counter(place)
        for batch in batches:
            for part in text_slices(batch):
                at, chunks, distinct = split_batch(part.column("text"))
                distinct = distinct.to_pylist()
                memo.learn(distinct)
                each = np.array([memo[c] for c in distinct], np.int64).reshape(-1, 2)[at]
                sums = np.concatenate((np.zeros((1, 2), np.int64), np.cumsum(each, axis=0)))
                ends = np.cumsum(chunks)
                words, tokens = (sums[ends] - sums[ends - chunks]).T
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words), pa.array(tokens)], names=["doc_id", "n_words", "n_tokens"]
                )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(count, "doc_id long, n_words long, n_tokens long")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and token counts of every document."""
    return token_counts(table(spark, sf_dir, "documents"))
