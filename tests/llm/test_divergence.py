import re
from collections import Counter

import numpy as np
import pyarrow as pa

from rosterlake.llm import divergence as dv
from rosterlake.llm.pointers import slices, three_way

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def wanted(rows, least, top):
    """The audit by plain loops over (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    seen, own = Counter(), Counter()
    for lang, source, text in rows:
        seen.update({(lang, t) for t in terms(text)})
        own.update((lang, source, t) for t in terms(text))
    out = []
    for lang in {r[0] for r in rows}:
        kept = sorted(t for (g, t), n in seen.items() if g == lang and n >= least)
        sources = sorted({r[1] for r in rows if r[0] == lang})

        def shares(counts):
            return [1 + 10**9 * (c + 1) // (sum(counts) + len(kept)) for c in counts]

        p = {s: shares([own[lang, s, t] for t in kept]) for s in sources}
        q = shares([sum(own[lang, s, t] for s in sources) for t in kept])
        for s in sources:
            pairs = [(sum((x - y) ** 2 // y for x, y in zip(p[s], p[o])), o) for o in sources if o != s]
            single = [((x - y) ** 2 // y, t) for x, y, t in zip(p[s], q, kept) if own[lang, s, t] and x > y]
            for part, found in (("pair", pairs), ("term", single)):
                ranked = sorted(found, key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked, 1) if part == "pair" or i <= top]
    return sorted(out)


def found(spark, rows, least=3, top=200):
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    return sorted(tuple(r) for r in dv.audit(spark, docs, least, top).select("lang", "source", "part", "item", "value", "rank").collect())


def test_three_way_sorts_and_marks_runs():
    rng = np.random.default_rng(3)
    for n, most in ((1, 1), (2, 1), (50, 3), (4000, 40), (3000, 10**9)):
        values = rng.integers(0, most + 1, n)
        order, key, first = np.arange(n), values.copy(), np.zeros(n, bool)
        starts, sizes = np.array([0, n // 3]), np.array([n // 3, n - n // 3])
        starts, sizes = starts[sizes > 0], sizes[sizes > 0]
        three_way(order, key, first, starts, sizes)
        for s, m in zip(starts, sizes):
            part = values[s : s + m]
            assert order[s : s + m].tolist() == (np.argsort(part, kind="stable") + s).tolist()
            assert key[s : s + m].tolist() == sorted(part)
            runs = slices(first, np.array([s]), np.array([m]))
            assert runs[1].tolist() == np.unique(part, return_counts=True)[1].tolist()


def test_runs_of_a_shard():
    texts = ["The the THE cat", "", "catalogue_catalogues;Cat ÄÖ äö", "x" * 20 + " " + "x" * 21, "naïve naïveté", None, "abcdefgh abcdefghi", "end", "begin"]
    group = np.array([0, 0, 1, 1, 0, 1, 0, 0, 0])
    got = dv.shard_runs(*dv.text_buffer(pa.array(["skipped", *texts]).slice(1)), group)
    n, docs = Counter(), Counter()
    for g, text in zip(group, texts):
        n.update((t, g) for t in terms(text))
        docs.update({(t, g) for t in terms(text)})
    assert {(t, g): (a, b) for t, g, a, b in zip(*(x.tolist() for x in got))} == {k: (n[k], docs[k]) for k in n}


def test_equals_plain_loops(spark, monkeypatch):
    rows = [(("de", "en", None)[i % 3], ("a", "b", "c", "d", None)[i % 5], " ".join(f"w{chr(97 + i * k % 13)}" for k in range(i % 17))) for i in range(90)]
    rows += [("xx", "alone", "one two"), ("en", "empty", ""), ("de", "mute", None), ("yy", "p", "few"), ("yy", "q", "others")]
    plain = wanted(rows, 3, 4)
    assert found(spark, rows, 3, 4) == plain
    # several blocks of pairs, several ways, and few terms at once
    monkeypatch.setattr(dv, "_SIDE", 2)
    monkeypatch.setattr(dv, "_ROWS", 5)
    monkeypatch.setattr("rosterlake.llm.divergence.fits_broadcast", lambda *_: False)
    assert found(spark, rows, 3, 4) == plain


def test_shares_beyond_a_long(spark):
    count, total, kept = 4 * 10**15, 9 * 10**15, 10**6
    row = spark.createDataFrame([(count, total, kept), (5, 0, 0)], "c long, t long, v long").select(dv.share("c", "t", "v").alias("p")).collect()
    assert [r.p for r in row] == [1 + 10**9 * (count + 1) // (total + kept), 1]


def test_awkward_rows(spark, awkward, nothing):
    got = dv.audit(spark, awkward, 1, 5)
    rows = [tuple(r) for r in awkward.select("lang", "source", "text").collect()]
    assert sorted(tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect()) == wanted(rows, 1, 5)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert dv.audit(spark, nothing).count() == 0


def test_one_term_of_many_bytes(spark):
    word = "ab" * 30_000
    assert [r for r in found(spark, [("en", "a", word)] * 3 + [("en", "b", "c")] * 3, 3) if r[2] == "term"][0][3] == word
