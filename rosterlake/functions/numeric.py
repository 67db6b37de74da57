"""Order-independent arithmetic.

Sums of doubles depend on the order in which partitions arrive, so a rounded mean could
change between two runs, or after a lost executor. Sums and means therefore add values of at
most four decimals (daily ratios, published hours) as whole ten-thousandths: adding longs
is exact and stays in generated code; decimals appear once per group, for the final rounding.

Every other value, however large, fine or infinite, is added as it is beside them, and counts alike. Sums
of dyadic fractions are still exact; only those of other fine values keep a double's dependence on order.
NaN is left out, like NULL. Whole sums that outgrow a long fall back to doubles; nothing is dropped or raises.
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 10_000
UNIT = Decimal("0.0001")
#: Above, a double does not tell whole units apart.
_MOST_UNITS = float(1 << 53)


def _number(value: str | Column) -> Column:
    """As double, whatever numeric type it comes in; NaN as NULL."""
    number = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.when(~F.isnan(number), number)


class _Total(NamedTuple):
    count: Column
    exact: Column  # whether whole units hold all of it
    decimal: Column
    double: Column


def _mixed(number: Column, part: Column, rest: Column, to_decimal) -> _Total:
    held = F.try_sum(part)
    count = F.count(number)
    decimal = to_decimal(held)
    overflow = held.isNull() & (F.count(part) > 0)
    double = F.when(overflow, F.sum(number)).otherwise(
        F.coalesce(decimal.cast("double"), F.lit(0.0)) + F.coalesce(F.sum(rest), F.lit(0.0))
    )
    return _Total(count, (F.count(rest) == 0) & held.isNotNull(), decimal, F.when(count > 0, double))


def _total(value: str | Column) -> _Total:
    number = _number(value)
    units = F.rint(number * UNITS)
    whole = (F.abs(units) < _MOST_UNITS) & (units / UNITS == number)
    return _mixed(
        number,
        F.when(whole, units.cast("bigint")),
        F.when(~whole, number),
        lambda held: held.cast("decimal(24,0)") * F.lit(UNIT),
    )


def exact_sum(value: str | Column, digits: int) -> Column:
    total = _total(value)
    return F.when(total.exact, F.round(total.decimal, digits).cast("double")).otherwise(
        F.round(total.double, digits)
    )


def exact_mean(value: str | Column, digits: int, half_even: bool = False) -> Column:
    """Mean rounded half up (or half even); NULL when there is nothing to average."""
    return _rounded_mean(value, digits, half_even, 1)


def exact_percent(value: str | Column, digits: int) -> Column:
    """Mean share as a percentage, rounded half even."""
    return _rounded_mean(value, digits, True, 100)


def _rounded_mean(value: str | Column, digits: int, half_even: bool, times: int) -> Column:
    rounding = F.bround if half_even else F.round
    total = _total(value)
    return F.when(
        total.exact, rounding(F.try_divide(total.decimal, total.count) * times, digits).cast("double")
    ).otherwise(rounding(F.try_divide(total.double, total.count) * times, digits))


def full_mean(value: str | Column) -> Column:
    """Mean without a final rounding: one sum, one double division."""
    total = _total(value)
    return F.try_divide(total.double, total.count)


def quotient_mean(value: Column) -> Column:
    """Mean of arbitrary quotients. Each is added with 18 decimals, so the sum does not depend on order;
    what 20 digits before the point cannot hold is added as a double."""
    number = _number(value)
    fixed = number.try_cast("decimal(38,18)")
    total = _mixed(number, fixed, F.when(fixed.isNull(), number), lambda held: held)
    return F.try_divide(total.double, total.count)


def row_count() -> Column:
    return F.count(F.lit(1))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as double; NULL for an empty whole."""
    return F.try_divide(F.lit(100.0) * part, whole)
