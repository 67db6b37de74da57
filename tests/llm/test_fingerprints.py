import hashlib
import re

import xxhash
from pyspark.sql import functions as F

from rosterlake.llm import fingerprints as fp


def windows(text):
    words = [""] * 4 + text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if words[4:] else set()


def test_edited_text_and_likeness(spark, documents):
    rows = documents.orderBy("doc_id").collect()
    got = {r.doc_id: r for r in fp.op8_fingerprints(spark, "/root/testdata/sf0.001").collect()}
    error = []
    for row, after in zip(rows, rows[1:] + rows[:1]):
        cut = len(row.text) // 4
        edited = row.text[: len(row.text) - cut] + after.text[:cut]
        mine = got[row.doc_id]
        assert (mine.n_chars, mine.edited_sha256) == (len(row.text), hashlib.sha256(edited.encode()).hexdigest())
        a, b = windows(row.text), windows(edited)
        error.append(mine.near_edited - len(a & b) / min(len(a), len(b)))
        assert 0 <= mine.near_edited <= 1 and 0 <= mine.near_next <= 1
    assert abs(sum(error) / len(error)) < 0.05 and sum(map(abs, error)) / len(error) < 0.12


def plain_sketch(text, one_in=fp.ONE_IN):
    """Hashes of the padded five-word windows by the hash function's own definition: each word's hash is the next one's seed."""
    words = [""] * 4 + [w for w in re.split(r"[ \t\n\x0b\f\r]+", text.lower()) if w]
    hashes = set()
    for i in range(len(words) - 4) if words[4:] else ():
        h = 42
        for w in words[i : i + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        hashes.add(h >> 16)
    return sorted(h for h in hashes if h < (1 << 48) // one_in or h == min(hashes))


def plain_containment(a, b):
    if not a and not b:
        return 1.0
    return len(set(a) & set(b)) / min(len(a), len(b)) if a and b else 0.0


def test_fingerprints_and_likeness_equal_brute_force(spark, documents):
    rows = documents.orderBy("doc_id").collect()
    got = {r.doc_id: r for r in fp.op8_fingerprints(spark, "/root/testdata/sf0.001").collect()}
    sketches = {r.doc_id: plain_sketch(r.text) for r in rows}
    for row, after in zip(rows, rows[1:] + rows[:1]):
        cut = len(row.text) // 4
        edited = plain_sketch(row.text[: len(row.text) - cut] + after.text[:cut])
        mine = got[row.doc_id]
        assert mine.fingerprint == "".join(f"{h:012x}" for h in sketches[row.doc_id])
        assert mine.edited_fingerprint == "".join(f"{h:012x}" for h in edited)
        assert mine.near_next == plain_containment(sketches[row.doc_id], sketches[after.doc_id])
        assert mine.near_edited == plain_containment(sketches[row.doc_id], edited)
    # a fingerprint is about half as long as its text: every fourth shingle at twelve digits
    size = sum(len(r.fingerprint) for r in got.values()) / sum(len(r.text) for r in rows)
    assert 0.3 < size < 0.7


def test_containment_of_very_unequal_texts(spark):
    """A text of a thousand words inside one of forty thousand."""
    words = [f"w{i * i % 99991}" for i in range(40_000)]
    rows = [(" ".join(words), " ".join(words[7000:8000])), (" ".join(words), " ".join(f"v{i}" for i in range(1000))), ("", ""), ("", "a b")]
    found = spark.createDataFrame(rows, "a string, b string").select(fp.containment(fp.sketch(F.col("a")), fp.sketch(F.col("b"))).alias("c")).collect()
    assert found[0].c > 0.95 and found[1].c < 0.05 and (found[2].c, found[3].c) == (1.0, 0.0)


def test_sketches_merge(spark):
    one, two = "eins zwei drei vier fünf sechs sieben acht neun zehn " * 3, "elf zwölf " + "dreizehn vierzehn fünfzehn " * 9
    both = spark.createDataFrame([(one, two)], "a string, b string").select(
        fp.merged(fp.sketch(F.col("a")), fp.sketch(F.col("b"))).alias("m"), fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b"))
    row = both.first()
    limit = (1 << 48) // fp.ONE_IN
    wanted = {x for x in row.a + row.b if x < limit} | {min(row.a + row.b)}
    assert set(row.m) == wanted and row.m == sorted(row.m)
    same = spark.createDataFrame([("A b",), ("a  B",)], "t string").select(fp.printed(fp.sketch(F.col("t"))).alias("f")).collect()
    assert same[0] == same[1] and len(same[0].f) % 12 == 0 and same[0].f


def test_ranges_do_not_matter(spark):
    ids = [5, -3, 10**15, 7, 8, 9, 100, 101, 10**15 + 1, 0] + list(range(1000, 1400))
    docs = spark.createDataFrame([(i, f"text of {i} " * 4) for i in ids], "doc_id long, text string")
    ordered = sorted(ids)
    after = dict(zip(ordered, ordered[1:] + ordered[:1]))
    for most in (2, 7, 64):
        got = fp.with_next(docs, most).collect()
        assert len(got) == len(ids)
        assert all(r.next_text == f"text of {after[r.doc_id]} " * 4 for r in got)


def test_awkward_rows(spark, awkward, nothing):
    found = fp.fingerprints(awkward)
    assert found.count() == awkward.count() and fp.fingerprints(nothing).count() == 0
    rows = found.collect()
    assert {r.n_chars for r in rows if r.doc_id == 1} == {0}
    repeated = [r.sketch for r in rows if r.n_chars == 55]
    assert len(repeated) == 3 and repeated[0] == repeated[1] == repeated[2] != []
    one = fp.fingerprints(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).first()
    assert one.edited == "abcdefab"
