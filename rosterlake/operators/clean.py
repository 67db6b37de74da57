"""Typing, filtering and enriching of raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.config import DEFAULTS, HOUR_COLUMNS, PROVIDER_FIELDS, Settings
from rosterlake.functions.calendar import parse_work_date
from rosterlake.functions.numeric import percent, row_count
from rosterlake.operators.joins import lookup_join


class SchemaMismatch(ValueError):
    """A table does not have the columns its contract names."""


def _hours(name: str) -> Column:
    """Text as double. 24 plain casts alone are generated into one method with what comes before them, which then is too long for
    the JVM to compile (8,000 bytes). The second way, by an array of one, keeps them out of such a method, each in one of its own; it
    says the same and is only gone for text without a value. Each column stands alone, so those nobody reads are left out."""
    return F.coalesce(F.col(name).try_cast("double"), F.transform(F.array(name), lambda text: text.try_cast("double"))[0])


def type_staffing(raw: DataFrame) -> DataFrame:
    """Text to types in one projection; what does not parse becomes NULL.

    Ids and labels stay text (leading zeros). Census goes through double
    because files carry it as ``72`` and as ``72.0``.
    """
    typed = {name: _hours(name) for name in HOUR_COLUMNS}
    typed["MDScensus"] = F.col("MDScensus").try_cast("double").try_cast("int")
    typed["WorkDate"] = parse_work_date(F.col("WorkDate"))
    return raw.withColumns(typed)


def select_provider(raw: DataFrame) -> DataFrame:
    """The nine attributes in use, renamed and typed; the other columns are never parsed."""
    chosen = []
    for header, (name, type_name) in PROVIDER_FIELDS.items():
        column = F.col(f"`{header}`")
        chosen.append((column if type_name == "string" else column.try_cast(type_name)).alias(name))
    return raw.select(*chosen)


def enough_census(staffing: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows at or above the census floor. NULL census is below it."""
    return staffing.filter(F.col("MDScensus") >= settings.census_floor)


def excluded_count(staffing: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Raw, kept and excluded rows, in one pass."""
    kept = F.count_if(F.col("MDScensus") >= settings.census_floor)
    return staffing.agg(
        row_count().alias("raw_rows"),
        kept.alias("kept_rows"),
        (row_count() - kept).alias("excluded_rows"),
    )


def join_provider(
    staffing: DataFrame,
    provider: DataFrame,
    small: bool | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Every staffing row with its provider's attributes, NULL where there is none."""
    return lookup_join(
        staffing, provider, "PROVNUM", "CCN",
        spread_by=("WorkDate", "MDScensus"), small=small, settings=settings,
    )


def matched(joined: DataFrame) -> DataFrame:
    return joined.filter(F.col("CCN").isNotNull())


def unmatched(joined: DataFrame) -> DataFrame:
    """The audit set: rows of facilities the provider file does not know."""
    return joined.filter(F.col("CCN").isNull())


def duplicate_providers(provider: DataFrame) -> DataFrame:
    """CCNs listed more than once; each would multiply its staffing rows in the join."""
    return provider.groupBy("CCN").agg(row_count().alias("rows")).filter("rows > 1")


def unique_providers(provider: DataFrame, key: str = "CCN") -> DataFrame:
    """One row for each CCN, so that the join cannot multiply staffing rows: the one with most attributes filled, and of those the
    greatest by its attributes in turn. A total order, so every run keeps the same. Rows without a CCN go: they join nothing."""
    others = [name for name in provider.columns if name != key]
    filled = sum((F.col(f"`{name}`").isNotNull().cast("int") for name in others), F.lit(0))
    best = F.max(F.struct(filled.alias("_filled"), *(F.col(f"`{name}`") for name in others))).alias("best")
    kept = provider.filter(F.col(key).isNotNull()).groupBy(key).agg(best)
    return kept.select(*(F.col(key) if name == key else F.col(f"best.`{name}`") for name in provider.columns))


def provider_conflicts(provider: DataFrame, key: str = "CCN") -> DataFrame:
    """CCNs listed more than once: how often, in how many different rows, and the attributes in which these differ (a missing one
    differs from any value)."""
    others = [name for name in provider.columns if name != key]
    differs = [
        F.when(
            (F.min(f"`{name}`") != F.max(f"`{name}`")) | ((F.count(f"`{name}`") > 0) & (F.count(f"`{name}`") < row_count())), F.lit(name)
        ) for name in others
    ]
    rows = provider.filter(F.col(key).isNotNull()).groupBy(key, *others).agg(row_count().alias("_n"))
    found = rows.groupBy(key).agg(F.sum("_n").alias("rows"), row_count().alias("variants"), F.array_join(F.array_compact(F.array(*differs)), ",").alias("conflicts"))
    return found.filter("rows > 1")


def contract_report(table: DataFrame, expected: tuple[str, ...]) -> DataFrame:
    """(column_name, status, filled_rows) of every expected or present column: ok, missing or unexpected, and how many
    rows of the table have a value in it."""
    present = {f"c{i}": name for i, name in enumerate(table.columns)}
    filled = table.select(*(F.col(f"`{name}`").isNotNull().cast("int").alias(slot) for slot, name in present.items()))
    counts = filled.unpivot([], list(present), "slot", "filled").groupBy("slot").agg(F.sum("filled").alias("filled_rows"))
    names = [*((slot, name, "ok" if name in expected else "unexpected") for slot, name in present.items()),
             *(("", name, "missing") for name in expected if name not in table.columns)]
    listed = table.sparkSession.range(1).select(F.inline(F.array(*(
        F.struct(F.lit(slot).alias("slot"), F.lit(name).alias("column_name"), F.lit(status).alias("status")) for slot, name, status in names
    ))))
    return listed.join(F.broadcast(counts), "slot", "left").select(
        "column_name", "status", F.when(F.col("status") != "missing", F.coalesce("filled_rows", F.lit(0).cast("long"))).alias("filled_rows")
    )


def require_columns(table: DataFrame, expected: tuple[str, ...]) -> DataFrame:
    """Stop on a missing or unexpected column (schema contract of Silver)."""
    missing = [name for name in expected if name not in table.columns]
    extra = [name for name in table.columns if name not in expected]
    if missing or extra:
        raise SchemaMismatch(f"missing columns {missing}, unexpected columns {extra}")
    return table


def join_coverage(staffing: DataFrame, provider: DataFrame) -> DataFrame:
    """How many facilities the provider file knows.

    Facilities are made distinct first, so the join sees one row per facility
    rather than one per day, and the counts need no second shuffle.
    """
    known = provider.select(F.col("CCN")).filter(F.col("CCN").isNotNull()).distinct()
    facilities = staffing.select("PROVNUM").filter(F.col("PROVNUM").isNotNull()).distinct()
    joined = facilities.join(known, facilities["PROVNUM"] == known["CCN"], "left")
    total = row_count()
    hit = F.count("CCN")
    return joined.agg(
        total.alias("facilities"),
        hit.alias("matched"),
        (total - hit).alias("unmatched"),
        F.round(percent(hit, total), 1).alias("match_pct"),
    )


def unmatched_ids(staffing: DataFrame, provider: DataFrame, n: int | None = 10) -> DataFrame:
    """Facilities without a provider row, the first ``n`` of them (None: all)."""
    facilities = staffing.select("PROVNUM").filter(F.col("PROVNUM").isNotNull()).distinct()
    known = provider.select("CCN").distinct()
    missing = facilities.join(
        known, facilities["PROVNUM"] == known["CCN"], "left_anti"
    ).orderBy("PROVNUM")
    return missing if n is None else missing.limit(n)
