import math

from pyspark.sql import functions as F

from rosterlake.llm import mixing


def test_counts_follow_the_rates(spark):
    docs = spark.range(60_000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 == 0, "big").when(F.col("id") < 600, "small").alias("source"))
    rates = {r.key: r for r in mixing.source_rates(docs, None, None, 0.5).collect()}
    assert math.isclose(sum(r.rate * r.n for r in rates.values()), 60_000)
    times = mixing.mix(docs).groupBy("source").count().collect()
    for row in times:
        expected = rates["none" if row.source is None else "s" + row.source]
        aim = expected.rate * expected.n
        assert abs(row["count"] - aim) < 5 * math.sqrt(aim)


def test_large_rates_and_given_weights(spark):
    docs = spark.createDataFrame([(i, "x", "a" if i < 20 else "b") for i in range(40)], "doc_id long, text string, source string")
    out = mixing.mix(docs, weights={"a": 1.0}, target=20 * 300)
    assert [r.source for r in out.select("source").distinct().collect()] == ["a"]
    counts = [r["count"] for r in out.groupBy("doc_id").count().collect()]
    assert len(counts) == 20 and all(200 < c < 400 for c in counts)
    assert out.groupBy("doc_id").agg(F.max("copy") == F.count("*")).filter("not `(max(copy) = count(1))`").count() == 0


def test_same_draw_every_time_and_shuffled(spark, documents):
    one = mixing.mix(documents).select("doc_id", "copy", "mix_key").collect()
    assert sorted(one) == sorted(mixing.mix(documents.orderBy(F.desc("doc_id"))).select("doc_id", "copy", "mix_key").collect())
    assert sorted(one) != sorted(mixing.mix(documents, seed=1).select("doc_id", "copy", "mix_key").collect())
    ids = [r.doc_id for r in one]
    assert ids != sorted(ids)


def test_awkward_rows(spark, awkward, nothing):
    out = mixing.mix(awkward, target=200)
    assert set(out.columns) == set(awkward.columns)
    assert out.filter("copy < 1").count() == 0 and {r.source for r in out.select("source").distinct().collect()} <= {None, "a", "b"}
    assert mixing.mix(nothing).count() == 0
    assert mixing.stage(spark, awkward, "").columns == awkward.columns and mixing.stage(spark, nothing, "").count() == 0
    assert mixing.mix(awkward, weights={}).count() == 0


def test_many_sources_are_not_broadcast(spark, monkeypatch):
    """The shuffled path, with a source that holds a third of the rows, gives the same rows."""
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("source"))
    usual = sorted(tuple(r) for r in mixing.mix(docs).select("doc_id", "copy").collect())
    monkeypatch.setattr("rosterlake.llm.common.fits_broadcast", lambda *_: False)
    assert sorted(tuple(r) for r in mixing.mix(docs).select("doc_id", "copy").collect()) == usual
