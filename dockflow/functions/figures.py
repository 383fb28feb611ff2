"""Rounded figures.

Each one is a single correctly rounded division of exact integers followed by one
half-up ``round``, so a tie such as 12.25 is never lost to an earlier rounding step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_SECOND = 1_000_000


def exact_sum(value: Column, times: Column | None = None) -> Column:
    """Sum of whole numbers, each counted ``times`` times, beyond the range of BIGINT."""
    big = value.cast("decimal(20,0)")
    return F.sum(big if times is None else big * times.cast("decimal(18,0)"))


def ratio(total: Column, count: Column, unit: int = 1) -> Column:
    """total / (count * unit) in double; NULL if the count is 0."""
    return F.try_divide(total.cast("double"), count.cast("double") * unit)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole; NULL if the whole is 0."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def change_percent(base: Column, now: Column, digits: int = 1) -> Column:
    """Growth over the base; NULL unless the base is positive."""
    return F.when(base > 0, percent(now - base, base, digits))


def seconds_as_minutes(seconds: Column, digits: int = 1) -> Column:
    return F.round(seconds / F.lit(60), digits)


def mean_minutes(total_seconds: Column, rides: Column, digits: int = 1) -> Column:
    """Mean duration from its exact sum."""
    return F.round(F.try_divide(total_seconds, rides * 60), digits)
