"""Numeric column expressions with fixed rounding and summation rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(x: Column, digits: int) -> Column:
    """Round half away from zero on the scaled double.

    ``F.round(x, digits)`` rounds the decimal text instead and gives another
    answer on values such as 1.005.
    """
    factor = float(10**digits)
    return F.round(x * F.lit(factor)) / F.lit(factor)


def is_finite(x: Column) -> Column:
    """True for ordinary numbers, false for NaN and both infinities, null for null."""
    return ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def sum_parts(x: Column, scale: int) -> tuple[Column, Column]:
    """``x`` as a decimal for an exact sum, and what no such decimal can hold.

    The second part keeps NaN, infinities and numbers of 10^(17 - scale) or more, whose doubles
    have no digits left at that scale.
    """
    small = F.abs(x) < F.lit(10.0 ** (17 - scale))
    # NaN compares above all numbers, so it is not small
    return F.when(small, x).cast(f"decimal(18,{scale})"), F.when(~small, x)


def whole_sum(exact: Column, rest: Column) -> Column:
    """The two sums of :func:`sum_parts` together; null if both are."""
    exact = exact.cast("double")
    return F.when(rest.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + rest)


def total(x: Column, scale: int | None = None, times: Column | None = None) -> Column:
    """Sum as double, each value ``times`` over; exact and independent of merge order when
    ``scale`` is given.  NaN and infinities reach the sum as in plain addition."""
    if scale is None:
        return F.sum(x if times is None else x * times).cast("double")
    exact, rest = sum_parts(x, scale)
    if times is not None:
        exact, rest = exact * times.cast("decimal(18,0)"), rest * times
    return whole_sum(F.sum(exact), F.sum(rest))


def mean(x: Column, scale: int | None = None) -> Column:
    if scale is None:
        return F.avg(x)
    # null instead of a division by zero when there are no values
    return F.try_divide(total(x, scale), F.count(x).cast("double"))


def clamp(x: Column, low: Column, high: Column) -> Column:
    """Bound ``x``; a null bound does not bind (``least``/``greatest`` skip nulls)."""
    return F.greatest(F.least(x, high), low)


def plain_number(x: Column) -> Column:
    """Shortest decimal text without exponent or trailing zeros, e.g. 101, 0.5."""
    digits = x.try_cast("decimal(38,18)").cast("string")
    stripped = F.regexp_replace(digits, r"\.?0+$", "")
    return F.when(digits.cast("double") == x, stripped).otherwise(x.cast("string"))


def min_max_score(x: Column, low: Column, high: Column) -> Column:
    """Position of ``x`` between ``low`` and ``high``; 0.5 if they coincide."""
    return F.when(high == low, F.lit(0.5)).otherwise(F.try_divide(x - low, high - low))
