"""Exact quantiles without sorting a column in one task.

Spark's exact ``percentile`` keeps every distinct value of a column in a single
aggregation buffer. Here the column is first reduced to (value, count), split into
buckets of similar numbers of distinct values, and the running count is taken inside
each bucket; only the bucket totals, a fixed number, are ever ordered together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.functions.numeric import row_count

BUCKETS = 64


def running_counts(counts: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(value, n) rows of each key with the ranks they take: ``from`` (inclusive) up to ``upto`` (exclusive) of ``total``,
    counted from 0 in the order of values. No window orders a whole key: only one of its ``BUCKETS`` buckets, and their sums.
    """
    # A quantile sketch of the distinct values: bounded in size, and only used to
    # place bucket borders, so its error never reaches the result. Asking for n keeps
    # this branch's shuffle identical to the main one, so Spark runs it once.
    borders = counts.filter("n > 0").groupBy(*by).agg(
        F.percentile_approx("value", [i / BUCKETS for i in range(1, BUCKETS)], 2000).alias("borders")
    )
    # One row of BUCKETS - 1 doubles per key: columns of a report, not values.
    bucketed = counts.join(F.broadcast(borders), list(by)).select(
        *by, "value", "n", F.size(F.filter("borders", lambda border: border < F.col("value"))).alias("bucket"),
    )
    per_key = Window.partitionBy(*by)
    totals = (
        bucketed.groupBy(*by, "bucket")
        .agg(F.sum("n").alias("bucket_n"))
        .withColumn("before", F.sum("bucket_n").over(
            per_key.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("total", F.sum("bucket_n").over(per_key))
        .select(*by, "bucket", F.coalesce("before", F.lit(0)).alias("before"), "total")
    )
    inside = Window.partitionBy(*by, "bucket").orderBy("value")
    return (
        bucketed.join(F.broadcast(totals), [*by, "bucket"])
        .withColumn("upto", F.col("before") + F.sum("n").over(inside))
        .withColumn("from", F.col("upto") - F.col("n"))
    )


def exact_quantiles(
    table: DataFrame, columns: tuple[str, ...], probabilities: dict[str, float]
) -> DataFrame:
    """One row per column, one output column per named probability.

    Linear interpolation between the two closest ranks; NULLs are left out.
    """
    counts = (
        table.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], list(columns), "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(row_count().alias("n"))
    )
    ranked = running_counts(counts, ("column_name",))
    picks = []
    for name, p in probabilities.items():
        place = F.lit(p) * (F.col("total") - 1)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (F.col("from") <= rank) & (rank < F.col("upto"))
            picks.append(F.max(F.when(here, F.col("value"))).alias(f"{name}_{side}"))
        picks.append(F.max(place - F.floor(place)).alias(f"{name}_part"))
    found = ranked.groupBy("column_name").agg(*picks)
    return found.select("column_name", *[
        (F.col(f"{name}_lo") + (F.col(f"{name}_hi") - F.col(f"{name}_lo")) * F.col(f"{name}_part"))
        .alias(name)
        for name in probabilities
    ])
