"""Means, plain and exact.

``rounded_mean`` is the everyday form. A sum of doubles depends on the order in
which tasks finish, so a mean that lies on a rounding midpoint can come out
either way from one run to the next. The exact forms sum whole units (cents, for
an amount) as bigint, which no task order can change.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_mean(column: str | Column, digits: int) -> Column:
    """Mean of a numeric column, rounded half up."""
    return F.round(F.avg(column), digits)


def to_units(column: str | Column, decimals: int) -> Column:
    """A value with at most ``decimals`` places as a whole number of units."""
    value = F.col(column) if isinstance(column, str) else column
    return F.rint(value * F.lit(10**decimals)).cast("bigint")


def exact_mean(total: Column, count: Column, unit_decimals: int) -> Column:
    """Unrounded mean from a bigint sum of units and a row count."""
    return total.cast("double") / F.nullif(count, F.lit(0)) / F.lit(10**unit_decimals)


def half_up_mean(total: Column, count: Column, unit_decimals: int, digits: int) -> Column:
    """Mean rounded half away from zero to ``digits``, in integer arithmetic only.

    ``total`` sums values counted in units of ``10**-unit_decimals``. A group
    without values gives NULL.
    """
    if digits > unit_decimals:
        raise ValueError("half_up_mean cannot round to more places than the units hold")
    step = 10 ** (unit_decimals - digits)
    size = F.abs(total)
    # Adding half of the divisor before an integer division rounds half up. The
    # divisor is even for every step but 1, where both sides are doubled.
    if step == 1:
        top, bottom = size * 2 + count, count * 2
    else:
        top, bottom = size + count * (step // 2), count * step
    steps = F.call_function("div", top, F.nullif(bottom, F.lit(0)))
    return F.when(total < 0, -steps).otherwise(steps).cast("double") / F.lit(10**digits)
