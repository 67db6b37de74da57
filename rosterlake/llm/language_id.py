"""Language identification with bit-sliced Bloom filters of character n-grams.

Training counts the n-grams of each language in Spark and keeps the frequent ones. All languages
share one filter: a slot holds a bit for each language, so one lookup per hash function
(combined by AND) tells every language that may know an n-gram. A text's popcounts
per language, less the hits that the filter's fill makes by chance, decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm.common import LIMITS, release, table, text_blocks
from rosterlake.operators.joins import fits_broadcast

UNDETERMINED = "und"
_BLOCK = 1 << 18
_LETTERS: np.ndarray | None = None


@dataclass(frozen=True)
class LanguageParams:
    """``docs_per_lang`` bounds the training sample: about so many labelled rows of each
    language, chosen by a hash of their id. ``min_share`` bounds what is learned: an n-gram counts as
    known to a language with at least this share of the language's n-grams of that size. A filter has ``2 ** slots_log2`` slots with a bit for each language,
    64 to a word; with so many languages that it would be larger than ``filter_bytes``, it has fewer slots."""

    sizes: tuple[int, ...] = (2, 3, 4)
    docs_per_lang: int = 3000
    min_share: float = 2e-5
    slots_log2: int = 20
    hashes: int = 3
    filter_bytes: int = 64 << 20


@dataclass(frozen=True)
class LanguageModel:
    """``slots``: a row for each slot, of one word, or of as many 64-bit words as the languages need."""

    langs: tuple[str, ...]
    slots: np.ndarray
    chance: np.ndarray
    params: LanguageParams = field(default_factory=LanguageParams)


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _cuts(text: str, size: int) -> Iterator[str]:
    """A long text in parts, cut after a space where there is one."""
    at = 0
    while len(text) - at > size:
        end = text.rfind(" ", at + size // 2, at + size) + 1 or at + size
        yield text[at:end]
        at = end
    yield text[at:]


def gram_hashes(texts: list[str], sizes: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each n-gram size: the n, hashes, and the text of each hash. Texts are lower-cased, runs of
    other characters than letters count as one space, and each text starts with a space."""
    lowered = [_code_points(" " + t.lower() + " ") for t in texts]
    chars = np.concatenate(lowered)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(x) for x in lowered])
    is_letter = _letters()[chars]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first other character after a word
    keep[np.cumsum([0] + [len(x) for x in lowered[:-1]])] = True  # the space in front
    chars = np.where(is_letter, chars, np.uint32(32))[keep].astype(np.uint64)
    owner = owner[keep]
    rolling, done = chars.copy(), 1
    for n in sorted(sizes):
        while done < n:
            rolling = rolling[:-1] * np.uint64(0x100000001B3) + chars[done:]
            done += 1
        inside = owner[: len(rolling)] == owner[n - 1 :][: len(rolling)]
        h = rolling[inside] + np.uint64(n)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        yield n, h, owner[: len(rolling)][inside]


def _positions(h: np.ndarray, n_slots: int, hashes: int) -> Iterator[np.ndarray]:
    low = np.uint64(n_slots - 1)
    step = (h >> np.uint64(32)) | np.uint64(1)
    for k in range(hashes):
        yield ((h + np.uint64(k) * step) & low).astype(np.int64)


def train(docs: DataFrame, params: LanguageParams = LanguageParams()) -> LanguageModel:
    """Learn from ``docs`` (columns text and lang; rows with a null in either teach nothing).

    Reach the driver: a count for each language, then at most ``1 / min_share`` n-grams for each
    language and size. A language with few rows is learned from those few; there may be any number of languages.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["lang"]: r["n"] for r in counted.collect()}
    langs = tuple(sorted(sizes, key=lambda x: (-sizes[x], x)))  # a tie goes to the commoner language
    dtype = next((t for bits, t in ((8, np.uint8), (16, np.uint16), (32, np.uint32)) if len(langs) <= bits), np.uint64)
    words = max(1, -(-len(langs) // 64))
    n_slots = 1 << min(params.slots_log2, (params.filter_bytes // (words * dtype().itemsize)).bit_length() - 1)
    slots = np.zeros((n_slots, words), dtype)
    if langs:
        share = F.least(F.lit(float(params.docs_per_lang)) / F.col("_n"), F.lit(1.0))
        rows_of = counted.withColumnRenamed("n", "_n")
        sample = labelled.join(F.broadcast(rows_of) if fits_broadcast(rows_of, LIMITS) else rows_of, "lang").filter(
            F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < share * (1 << 20)
        )

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for lang, rows in batch.groupby("lang"):
                    for _, texts in text_blocks(rows["text"], rows["text"], _BLOCK):
                        for text_part in ([texts] if len(texts) > 1 else [[t] for t in _cuts(texts[0], _BLOCK)]):
                            for n, h, _ in gram_hashes(text_part, params.sizes):
                                grams, seen = np.unique(h, return_counts=True)
                                yield pd.DataFrame({"lang": lang, "size": n, "gram": grams.view(np.int64), "n": seen})
            release()

        counts = (
            sample.select("lang", "text")
            .mapInPandas(count, "lang string, size int, gram long, n long")
            .groupBy("lang", "size", "gram")
            .agg(F.sum("n").alias("n"))
        )
        counts = counts.persist()
        totals = counts.groupBy("lang", "size").agg((F.sum("n") * params.min_share).alias("least"))
        frequent = counts.join(F.broadcast(totals), ["lang", "size"]).filter("n >= least").select("lang", "gram").toPandas()
        counts.unpersist()
        for lang, grams in frequent.groupby("lang")["gram"]:
            i = langs.index(lang)
            for at in _positions(grams.to_numpy(np.int64).view(np.uint64), n_slots, params.hashes):
                slots[at, i // 64] |= dtype(1 << i % 64)
    fill = np.array([np.count_nonzero(slots[:, i // 64] >> dtype(i % 64) & dtype(1)) / n_slots for i in range(len(langs))])
    return LanguageModel(langs, slots, fill**params.hashes, params)


def _hits(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Popcounts by text and language, and n-grams by text."""
    n_slots, words = model.slots.shape
    width = words * model.slots.dtype.itemsize
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    found = np.zeros((len(texts), width, 8), np.int64)
    grams = np.zeros(len(texts), np.int64)
    for _, h, owner in gram_hashes(texts, model.params.sizes):
        if not len(h):
            continue
        at = _positions(h, n_slots, model.params.hashes)
        mask = model.slots[next(at)]
        for more in at:
            mask &= model.slots[more]
        for plane, byte in enumerate(np.moveaxis(mask.view(np.uint8).reshape(-1, width), 1, 0)):
            if byte.any():
                found[:, plane] += np.bincount(owner * np.int64(256) + byte, minlength=len(texts) * 256).reshape(-1, 256) @ bits
        grams += np.bincount(owner, minlength=len(texts))
    return found.reshape(len(texts), -1)[:, : len(model.langs)], grams


def predict(texts: list[str | None], model: LanguageModel) -> tuple[list[str], list[float]]:
    """The language and a score for each text: the share of its n-grams that the language knows,
    chance hits taken off. A null, a text without letters, or an empty model gives ``und`` and 0."""
    langs, scores = [], []
    for _, some in text_blocks(texts, texts, _BLOCK):
        if len(some) == 1:
            parts = [_hits([part], model) for part in _cuts(some[0], _BLOCK)]
            hits, grams = sum(p[0] for p in parts), sum(p[1] for p in parts)
        else:
            hits, grams = _hits(some, model)
        if not model.langs:
            langs += [UNDETERMINED] * len(some)
            scores += [0.0] * len(some)
            continue
        right = np.maximum(0, hits - grams[:, None] * model.chance) / (1 - model.chance)
        best = right.argmax(axis=1)
        share = right[np.arange(len(some)), best] / np.maximum(grams, 1)
        langs += [model.langs[b] if n else UNDETERMINED for b, n in zip(best, grams)]
        scores += np.clip(share, 0, 1).tolist()
    return langs, scores


def _guess(spark: SparkSession, model: LanguageModel):
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang string, score double>")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            langs, scores = predict(texts, sent.value)
            yield pd.DataFrame({"lang": langs, "score": scores})
            release()

    return guess


def identify(spark: SparkSession, docs: DataFrame, model: LanguageModel, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score; other columns stay as they are, but for
    input columns of those two names, which give way."""
    found = docs.select(F.struct("*").alias("d"), _guess(spark, model)("text").alias("g"))
    kept = [F.col(f"d.`{c}`") for c in docs.columns if c not in (lang, score)]
    return found.select(*kept, F.col("g.lang").alias(lang), F.col("g.score").alias(score))


def held_out():
    """Rows that teach nothing, kept for measuring."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document. A null id is never held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = F.coalesce(held_out(), F.lit(False))
    model = train(docs.filter(~out))
    return identify(spark, docs.select("doc_id", out.alias("held_out"), "text"), model).drop("text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.25) -> DataFrame:
    """Pipeline stage: documents in no learned language go (undetermined, or a score below
    ``least``); a missing ``lang`` is filled in. Columns stay those of ``docs``."""
    model = train(docs.filter(~F.coalesce(held_out(), F.lit(False))))
    found = docs.select(F.struct("*").alias("d"), _guess(spark, model)("text").alias("g")).filter(
        (F.col("g.lang") != UNDETERMINED) & (F.col("g.score") >= least)
    )
    return found.select(
        *(F.coalesce("d.lang", "g.lang").alias(c) if c == "lang" else F.col(f"d.`{c}`") for c in docs.columns)
    )
