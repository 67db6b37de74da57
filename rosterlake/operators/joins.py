"""Joining a fact table to a keyed lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

from rosterlake.functions.numeric import row_count
from rosterlake.config import DEFAULTS, Settings
from rosterlake.session import staged

SALT, HOT, WAYS = "_salt", "_hot", "_ways"


def _width(column: Column, kind: DataType) -> Column:
    """Bytes of a value in memory, about: text and binary by length, arrays and structs by what they hold."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, ArrayType):
        fixed = not isinstance(kind.elementType, (StringType, BinaryType, ArrayType, StructType, MapType))
        held = F.size(column) * 8 if fixed else F.aggregate(column, F.lit(0), lambda so_far, x: so_far + _width(x, kind.elementType))
        return F.coalesce(F.when(column.isNotNull(), held), F.lit(0)) + 24
    if isinstance(kind, StructType):
        return sum((_width(column[field.name], field.dataType) for field in kind.fields), F.lit(16))
    if isinstance(kind, MapType):
        return _width(F.map_keys(column), ArrayType(kind.keyType)) + _width(F.map_values(column), ArrayType(kind.valueType))
    return F.lit(16)


def lookup_size(lookup: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a lookup. One aggregation with map-side partials: two numbers reach the driver."""
    width = sum((_width(F.col(f"`{field.name}`"), field.dataType) for field in lookup.schema.fields), F.lit(0))
    rows, size = lookup.agg(row_count(), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    return rows, size


def fits_broadcast(lookup: DataFrame, settings: Settings = DEFAULTS) -> bool:
    """Measure the lookup (rows and bytes) against the broadcast bounds."""
    rows, size = lookup_size(lookup)
    return rows <= settings.broadcast_max_rows and size <= settings.broadcast_max_bytes


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    fact_key: str,
    lookup_key: str,
    spread_by: tuple[str, ...],
    how: str = "left",
    small: bool | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """``facts`` joined to ``lookup`` on one key, both key columns kept.

    A lookup inside the measured bounds is broadcast: the facts do not move. A larger
    one is shuffled, with hot keys split (see ``_salted_join``). The result is the same.

    ``small`` passes on an earlier measurement; None measures here.
    """
    if small is None:
        small = fits_broadcast(lookup, settings)
    if small:
        return facts.join(F.broadcast(lookup), facts[fact_key] == lookup[lookup_key], how)
    return _salted_join(facts, lookup, fact_key, lookup_key, spread_by, how, settings)


def hot_keys(facts: DataFrame, key: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Keys holding more than ``hot_share`` of the rows, and in how many parts to split each.

    The counts are written once to shared scratch: the total and the hot keys come from there, so the facts
    are read once for them.

    A share of 1/1000 leaves at most 1000 of them, however large the table: small enough
    to broadcast by construction.
    """
    counts = staged(facts.sparkSession, facts.groupBy(key).agg(row_count().alias("n")), "key-counts")
    limit = F.greatest(
        counts.agg((F.sum("n") * F.lit(settings.hot_share)).alias("n")).scalar(), F.lit(1.0)
    )
    return counts.filter(F.col(key).isNotNull() & (F.col("n") > limit)).select(
        F.col(key).alias(HOT), F.ceil(F.col("n") / limit).cast("int").alias(WAYS)
    )


def _salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    fact_key: str,
    lookup_key: str,
    spread_by: tuple[str, ...],
    how: str,
    settings: Settings,
) -> DataFrame:
    """Join on (key, salt). A hot key gets as many salts as it has shares of rows, its
    lookup rows are repeated once per salt, and all other keys use salt 0.

    A fact's salt is a hash of its own ``spread_by`` columns: the same again after a
    lost executor. Facts without a key match nothing and are only spread.
    """
    hot = hot_keys(facts, fact_key, settings)
    ways = F.when(F.col(fact_key).isNull(), F.lit(int(1 / settings.hot_share))).otherwise(
        F.coalesce(F.col(WAYS), F.lit(1))
    )
    left = (
        facts.join(F.broadcast(hot), F.col(fact_key) == F.col(HOT), "left")
        .withColumn(SALT, F.pmod(F.xxhash64(*spread_by), ways).cast("int"))
        .drop(HOT, WAYS)
    )
    right = (
        lookup.join(F.broadcast(hot), F.col(f"`{lookup_key}`") == F.col(HOT), "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(WAYS), F.lit(1)) - 1)))
        .drop(HOT, WAYS)
    )
    joined = left.join(
        right, (left[fact_key] == right[lookup_key]) & (left[SALT] == right[SALT]), how
    )
    return joined.drop(left[SALT]).drop(right[SALT])
