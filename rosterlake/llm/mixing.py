"""Mixing sources to target weights by Poisson replication.

Each document is repeated a random number of times: a Poisson number with its source's mean repetition
rate, inverted from hashes of its id, so that every run draws the same. A rate above
``_PART`` is a sum of equal smaller ones, so no distribution table grows with a rate. Column expressions only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm.common import join_counted, table, with_columns

_PART = 16.0
#: Terms of a distribution function: beyond, a Poisson number of mean 16 has probability under 1e-16.
_TERMS = 80


def unit(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts' texts, joined by colons. A null part counts as empty."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None, target: float | None, power: float) -> DataFrame:
    """For each source: key, n, the parts its rate is split into, and the distribution function of one part.

    Without ``weights`` a source weighs its number of documents to the ``power``. ``target``
    is the expected number of documents in the mix; by default as many as there are.
    """
    sources = docs.groupBy(_key(F.col("source")).alias("key")).agg(F.count(F.lit(1)).alias("n"), F.first("source").alias("source"))
    if weights is None:
        weight = F.sqrt(F.col("n").cast("double")) if power == 0.5 else F.pow(F.col("n").cast("double"), F.lit(power))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source") == name, float(value)).otherwise(weight)
    weighed = sources.withColumn("w", weight)
    whole = weighed.agg(F.sum("w").alias("w"), F.sum("n").cast("double").alias("n"))
    aim = whole.select("n").scalar() if target is None else F.lit(float(target))
    rate = F.coalesce(F.try_divide(aim * F.col("w"), whole.select("w").scalar()), F.lit(0.0)) / F.col("n")
    parts = F.greatest(F.ceil(F.col("rate") / _PART), F.lit(1)).cast("int")
    mean = F.col("rate") / F.col("parts")
    start = F.struct(F.exp(-mean).alias("term"), F.exp(-mean).alias("sum"), F.array(F.exp(-mean)).alias("cdf"))

    def add(state: Column, k: Column) -> Column:
        term = state["term"] * mean / k
        return F.struct(term.alias("term"), (state["sum"] + term).alias("sum"), F.array_append(state["cdf"], state["sum"] + term).alias("cdf"))

    cdf = F.aggregate(F.sequence(F.lit(1), F.lit(_TERMS)), start, add, lambda state: state["cdf"])
    return weighed.withColumn("rate", rate).withColumn("parts", parts).select("key", "n", "rate", "parts", cdf.alias("cdf"))


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("none"))


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    target: float | None = None,
    power: float = 0.5,
    seed: int = 0,
    copy: str = "copy",
    order: str = "mix_key",
) -> DataFrame:
    """``docs`` repeated and shuffled: each row's ``copy`` runs from 1, ``order`` is the random number that, with the row's content, deals rows
    to partitions and sorts them there.

    A null source is a source of its own. Rows with one id draw the same number. An empty table gives no rows, a
    source without weight gives none. Input columns named ``copy`` and ``order`` give way.
    """
    rates = source_rates(docs, weights, target, power)
    packed = docs.select(F.struct("*").alias("d"), _key(F.col("source")).alias("key"))
    # a few hundred sources go to all tasks, measured; more are shuffled with hot sources split
    total = docs.count()
    rated = join_counted(packed, rates, "key", F.xxhash64("d.doc_id"), total)
    drawn = F.aggregate(
        F.sequence(F.lit(0), F.col("parts") - 1),
        F.lit(0),
        lambda so_far, part: so_far + F.size(F.filter("cdf", lambda edge: edge <= unit(F.lit(seed), F.col("d.doc_id"), part))),
    )
    repeated = rated.select("d", drawn.alias("times")).filter("times > 0").select("d", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("c"))
    dealt = repeated.select("d.*", F.col("c").alias(copy)) if copy not in docs.columns else with_columns(repeated.select("d.*", "c"), {copy: F.col("c")}).drop("c")
    dealt = with_columns(dealt, {order: unit(F.lit(seed + 1), F.col("doc_id"), F.col(copy))})
    # rows that share an id (or have none) draw one number: what is in them parts them
    content = F.xxhash64(*(F.col(f"`{c}`") for c in dealt.columns))
    return dealt.repartition(F.col(order), content).sortWithinPartitions(order)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents, sources weighing the square root of their size."""
    return mix(table(spark, sf_dir, "documents"))


#: The same draw for DuckDB.
OP6_SQL = f"""
WITH d AS (SELECT *, coalesce('s' || source, 'none') AS k FROM documents),
s AS (SELECT k, count(*) AS n, sqrt(count(*)::DOUBLE) AS w FROM d GROUP BY k),
t AS (SELECT sum(w) AS w, sum(n)::DOUBLE AS n FROM s),
r AS (SELECT s.k, (t.n * s.w / t.w) / s.n AS rate FROM s, t),
p AS (SELECT k, greatest(ceil(rate / {_PART}), 1)::INT AS parts, rate / greatest(ceil(rate / {_PART}), 1)::INT AS m FROM r),
c AS (
  WITH RECURSIVE go AS (
    SELECT k, parts, m, 0 AS i, exp(-m) AS term, exp(-m) AS edge FROM p
    UNION ALL
    SELECT k, parts, m, i + 1, term * m / (i + 1), edge + term * m / (i + 1) FROM go WHERE i < {_TERMS}
  ) SELECT k, parts, list(edge ORDER BY i) AS cdf FROM go GROUP BY k, parts
),
u AS (
  SELECT d.*, x.times FROM d JOIN c USING (k), LATERAL (
    SELECT list_sum(list_transform(range(0, c.parts), lambda j: len(list_filter(c.cdf, lambda e: e <=
      ('0x' || substr(md5('0:' || coalesce(d.doc_id::VARCHAR, '') || ':' || j::VARCHAR), 1, 12))::BIGINT::DOUBLE / {float(1 << 48)})))) AS times
  ) x
),
e AS (SELECT *, unnest(range(1, times::BIGINT + 1)) AS copy FROM u)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy,
  ('0x' || substr(md5('1:' || coalesce(doc_id::VARCHAR, '') || ':' || copy::VARCHAR), 1, 12))::BIGINT::DOUBLE / {float(1 << 48)} AS mix_key
FROM e
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the mix, in the columns of ``docs``."""
    kept = docs.select(F.struct("*").alias("row"), "doc_id", "source")
    return mix(kept).select("row.*")
