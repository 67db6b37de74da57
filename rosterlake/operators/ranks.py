"""Rank correlation from histograms of values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.functions.numeric import row_count
from rosterlake.operators.quantiles import running_counts


def paired(table: DataFrame, groups: tuple[str, ...], measures: tuple[str, ...], qualities: tuple[str, ...]) -> DataFrame:
    """(groups, measure, quality, x, y) for each row and each two columns that both have a value; NaN is none."""
    numbers = {name: F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")) for name in (*measures, *qualities)}
    wide = table.select(*groups, *(value.alias(name) for name, value in numbers.items()))
    by_measure = wide.unpivot([*groups, *qualities], list(measures), "measure", "x").filter("x IS NOT NULL")
    return by_measure.unpivot([*groups, "measure", "x"], list(qualities), "quality", "y").filter("y IS NOT NULL")


def rank_correlations(table: DataFrame, groups: tuple[str, ...], measures: tuple[str, ...], qualities: tuple[str, ...]) -> DataFrame:
    """For each group, measure and quality: how many rows have both, and the correlation of their ranks; equal values share
    the middle of their ranks. NULL where either column has one value only.

    Rows fold to (x, y, count) first, and ranks are running counts over values. Sums of doubled ranks are whole numbers, so
    the result depends on no order; only the last step divides.
    """
    key = (*groups, "measure", "quality")
    pairs = paired(table, groups, measures, qualities).groupBy(*key, "x", "y").agg(row_count().alias("n"))

    def ranks(side: str) -> DataFrame:
        counts = pairs.groupBy(*key, F.col(side).alias("value")).agg(F.sum("n").alias("n"))
        doubled = (F.col("from") + F.col("upto") + 1).cast("decimal(18,0)")
        return running_counts(counts, key).select(*key, F.col("value").alias(side), doubled.alias(f"r{side}"))

    ranked = pairs.join(ranks("x"), [*key, "x"]).join(ranks("y"), [*key, "y"])
    n, rx, ry = F.col("n").cast("decimal(18,0)"), F.col("rx"), F.col("ry")

    def total(part) -> object:
        return F.sum((n * part).cast("decimal(38,0)")).cast("decimal(38,0)")

    sums = ranked.groupBy(*key).agg(
        F.sum("n").alias("facilities"), total(rx).alias("sx"), total(ry).alias("sy"),
        total(rx * ry).alias("sxy"), total(rx * rx).alias("sxx"), total(ry * ry).alias("syy"),
    )
    count = F.col("facilities").cast("decimal(18,0)")

    def spread(product: str, one: str, two: str):
        return ((count * F.col(product)).cast("decimal(38,0)") - (F.col(one) * F.col(two)).cast("decimal(38,0)")).cast("double")

    both = F.sqrt(spread("sxx", "sx", "sx")) * F.sqrt(spread("syy", "sy", "sy"))
    return sums.select(*key, "facilities", F.round(F.try_divide(spread("sxy", "sx", "sy"), both), 6).alias("rank_correlation"))
