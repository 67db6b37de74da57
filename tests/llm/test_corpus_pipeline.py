"""The pipeline: stages in order, their contracts, and run() against a brute-force version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from rosterlake.llm.words import vocabulary_path
from test_language_id import exact_grams
from test_near_duplicates import brute_classes
from test_personal_data import BASE, brute

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "personal_data", "source_mixing", "best_fit_packing"]


def plain_language(rows, least=0.25):
    """Ids of texts in a learned language: with sets of frequent n-grams in place of the filter."""
    counts = {}
    for r in rows:
        if r.lang and r.text and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            own = counts.setdefault(r.lang, {2: Counter(), 3: Counter(), 4: Counter()})
            for gram in exact_grams(r.text):
                own[len(gram)][gram] += 1
    known = {lang: {g for c in own.values() for g, n in c.items() if n >= c.total() * 2e-5} for lang, own in counts.items()}
    kept = []
    for r in rows:
        grams = exact_grams(r.text or "")
        if any(c.isalpha() for c in r.text or "") and max(sum(g in k for g in grams) for k in known.values()) >= least * len(grams):
            kept.append(r)
    return kept


SECRET = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}")
SECRET_WORDS = re.compile(r"(?<![a-z0-9])(?:(?:[a-z0-9]+_)*(?:tokens?|keys?|secrets?|pass(?:word|wd|phrase)|pwd|credentials?|auth(?:orization)?)|api|bearer)(?![a-z0-9])")


def plain_mask(text):
    """The base kinds by their patterns, one after the other, then secrets by the words around them."""
    for kind, pattern in BASE.items():
        out, at = "", 0
        for span in [f.split(":") for f in brute(text) if f.startswith(kind + ":")]:
            out += text[at : int(span[1])] + f"[{kind.upper()}]"
            at = int(span[2])
        text = out + text[at:]
    assert not re.search(r"\b[A-Z]{2}[0-9]{2}[A-Z0-9 ]{11,}|[0-9]{3}-[0-9]{2}-[0-9]{4}", text)

    def hide(m):
        hit, near = m[0], text[max(0, m.start() - 40) : m.start()] + "\n" + text[m.end() : m.end() + 24]
        secret = re.search("[0-9]", hit) and re.search("[A-Za-z]", hit) and len(set(hit)) >= 9 and SECRET_WORDS.search(near.lower())
        return "[SECRET]" if secret else hit

    return SECRET.sub(hide, text)


def plain_copies(rows):
    """How often each document comes: a Poisson number, its distribution added up term by term."""
    n = Counter(r.source for r in rows)
    total = sum(math.sqrt(x) for x in n.values())
    out = {}
    for r in rows:
        rate = len(rows) * math.sqrt(n[r.source]) / total / n[r.source]
        parts = max(1, math.ceil(rate / 16))
        times = 0
        for part in range(parts):
            draw = int(hashlib.md5(f"0:{r.doc_id}:{part}".encode()).hexdigest()[:12], 16) / 2**48
            term = edge = math.exp(-rate / parts)
            k = 0
            while edge <= draw and k < 80:
                k += 1
                times += 1
                term *= rate / parts / k
                edge += term
        out[r.doc_id] = times
    return out


def test_run_equals_brute_force(spark, documents):
    """All five stages by plain code; only the numbers of the tokenizer are the tokenizer's."""
    kept = plain_language(documents.collect())
    firsts = {min(group) for group in brute_classes([(r.doc_id, r.text) for r in kept])}
    left = [r for r in kept if r.doc_id in firsts]
    copies = plain_copies(left)
    tokenizer, wanted = Tokenizer.from_file(vocabulary_path()), Counter()
    for r in left:
        masked = plain_mask(r.text)
        ids = tokenizer.encode(masked, add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            wanted[r.doc_id, piece, at, len(part), zlib.crc32(part.tobytes())] += copies[r.doc_id]
    out = corpus_pipeline.run(spark, SF)
    got = Counter(tuple(r)[:5] for r in out.select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    assert got == +wanted


def test_plain_mask_equals_the_stage(spark):
    """What the plain version above hides, on a larger table, secrets too."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["personal_data"](spark, docs, SF).collect()}
    wanted = {r.doc_id: plain_mask(r.text) for r in docs.collect()}
    assert got == wanted and sum("[SECRET]" in text for text in wanted.values()) > 5


def test_stages_keep_columns_and_take_nothing(spark, awkward, nothing):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, awkward, SF).columns == awkward.columns, name
        assert stage(spark, nothing, SF).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, nothing, SF).count() == 0
