from collections import Counter

import pytest
from pyspark.sql import functions as F

from rosterlake.llm import language_id as li


def test_held_out_accuracy(spark):
    found = li.op2_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = found.filter("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert found.count() == 1000 and right > 0.97
    assert found.agg(F.min("score") >= 0, F.max("score") <= 1).first() == (True, True)


def test_prediction_reads_the_text_only(spark, documents):
    model = li.train(documents)
    disguised = documents.withColumns({"lang": F.lit("xx"), "source": F.lit("y"), "doc_id": F.col("doc_id") + 9})
    one = li.identify(spark, documents, model).orderBy("text").select("lang_pred", "score").collect()
    assert one == li.identify(spark, disguised, model).orderBy("text").select("lang_pred", "score").collect()


def test_filter_answers_like_sets_up_to_chance(documents):
    model = li.train(documents)
    texts = [r.text for r in documents.limit(40).collect()]
    hits, grams = li._hits(texts, model)
    assert (hits <= grams[:, None]).all() and (hits.max(axis=1) > 0).all()
    parts = [li._hits([t], model) for t in texts]  # a batch counts as its texts one by one
    assert [p[0][0].tolist() for p in parts] == hits.tolist()


def exact_grams(text):
    """Letters and single spaces as the model reads them, cut into n-grams by plain slicing."""
    chars = "".join(c if c.isalpha() else " " for c in " " + text.lower() + " ")
    kept = "".join(c for i, c in enumerate(chars) if i == 0 or c != " " or chars[i - 1] != " ")
    return [kept[i : i + n] for n in (2, 3, 4) for i in range(len(kept) - n + 1)]


def test_predictions_equal_those_of_exact_sets(spark, documents):
    """The same model with a set of n-grams for each language in place of the filter."""
    model = li.train(documents)
    rows = documents.collect()
    counts = {lang: {2: Counter(), 3: Counter(), 4: Counter()} for lang in model.langs}
    for r in rows:
        for gram in exact_grams(r.text) if r.lang and r.text else ():
            counts[r.lang][len(gram)][gram] += 1
    known = {
        lang: {g for own in by_size.values() for g, n in own.items() if n >= own.total() * model.params.min_share} for lang, by_size in counts.items()
    }
    langs, scores = li.predict([r.text for r in rows], model)
    for r, lang, score in zip(rows, langs, scores):
        grams = exact_grams(r.text or "")
        share = {x: sum(g in known[x] for g in grams) / max(len(grams), 1) for x in model.langs}
        if not any(c.isalpha() for c in r.text or ""):
            assert (lang, score) == ("und", 0.0)
            continue
        best = max(share.values())
        assert share[lang] >= best - 0.01 and abs(score - share[lang]) < 0.01
        if sorted(share.values())[-2] < best - 0.01:
            assert share[lang] == best


@pytest.mark.parametrize("n", [3, 64, 65, 150])
def test_any_number_of_languages(spark, n):
    """As many labels as a table has, past a machine word too; a small filter is less sharp but still answers."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    made = [(i, " ".join(letters[(i * 7 + k) % 26] + letters[(i * 11 + k * k) % 26] + letters[i % 26] * (1 + i % 3) for k in range(40)), f"l{i % n:03d}") for i in range(n * 4)]
    docs = spark.createDataFrame([(i, t + f" {letters[int(g[1:]) // 26]}{letters[int(g[1:]) % 26]}x" * 30, g) for i, t, g in made], "doc_id long, text string, lang string")
    model = li.train(docs)
    assert len(model.langs) == n and model.slots.shape[1] == -(-n // 64)
    found = li.identify(spark, docs, model).select("lang", "lang_pred", "score").collect()
    assert all(0 <= r.score <= 1 for r in found) and sum(r.lang == r.lang_pred for r in found) > 0.95 * len(found)
    tight = li.train(docs, li.LanguageParams(filter_bytes=1 << 18))
    assert tight.slots.nbytes <= 1 << 18
    assert {r.lang_pred for r in li.identify(spark, docs, tight).collect()} <= {*model.langs}


def test_awkward_rows(spark, awkward, documents):
    found = li.identify(spark, awkward, li.train(documents))
    assert set(found.columns) == set(awkward.columns) and found.count() == awkward.count()
    by_text = {r.text: (r.lang_pred, r.score) for r in found.collect()}
    for blank in (None, "", "   \n\t ", "!!! 123 --"):
        assert by_text[blank] == ("und", 0.0)
    assert {r.lang_pred for r in li.identify(spark, awkward, li.train(documents.limit(0))).collect()} == {"und"}


def test_stage_rejects_what_is_in_no_language(spark, documents, awkward, nothing):
    kept = li.stage(spark, documents, "")
    assert kept.columns == documents.columns and kept.count() == documents.count()  # clean documents stay
    junk = spark.createDataFrame([(900, "#### 1234 !!", None, "a", 12), (901, None, None, "a", 0)], documents.schema)
    mixed = li.stage(spark, documents.union(junk), "")
    assert mixed.count() == documents.count()
    bare = documents.withColumn("lang", F.when(F.col("doc_id") % 5 > 0, F.col("lang")))
    assert li.stage(spark, bare, "").filter("lang is null").count() == 0
    assert li.stage(spark, awkward, "").columns == awkward.columns
    assert li.stage(spark, nothing, "").count() == 0
