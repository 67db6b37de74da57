"""Dates and quarter labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterlake.config import QUARTER_IN_NAME, SHIFTED_DAYS, WORK_DATE_FORMAT


def parse_work_date(text: Column) -> Column:
    """``yyyyMMdd`` text to DATE; anything else is NULL, also under ANSI mode."""
    return F.try_to_date(text, WORK_DATE_FORMAT)


def quarter_label(day: Column) -> Column:
    """2024-05-03 -> ``2024Q2``."""
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def quarter_from_name(name: Column) -> Column:
    """``..._Q2_2024.csv`` -> ``2024Q2``; NULL when the name holds no quarter."""
    found = F.regexp_extract(name, QUARTER_IN_NAME, 0)
    return F.nullif(F.regexp_replace(found, QUARTER_IN_NAME, "$2Q$1"), F.lit(""))


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def week_start(day: Column) -> Column:
    """Monday of the Monday-to-Sunday week."""
    return F.date_trunc("week", day).cast("date")


def shift_one_quarter(day: Column, every_day: bool = False, year: int | None = None) -> Column:
    """Move a date three months on.

    By default only the days the published generator listed move (all of April,
    the first ten days of May and of June); ``every_day`` moves all of them.
    ``year`` restricts the move to that year.
    """
    moved = F.add_months(day, 3)
    if every_day:
        chosen = F.lit(True)
    else:
        last_day = F.lit(0)
        for month, limit in SHIFTED_DAYS.items():
            last_day = F.when(F.month(day) == month, F.lit(limit)).otherwise(last_day)
        chosen = F.dayofmonth(day) <= last_day
    if year is not None:
        chosen = chosen & (F.year(day) == year)
    return F.when(chosen, moved).otherwise(day)
