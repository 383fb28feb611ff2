"""Shares and scales over small aggregated results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.functions.figures import percent
from dockflow.functions.trip import rides


def share_of(rides: str, group: Sequence[str] = (), digits: int = 1) -> Column:
    """Percentage of the group's rides; of all rides without a group.

    For results that are already aggregated to a handful of rows.
    """
    window = Window.partitionBy(*(group or [F.lit(0)]))
    return percent(F.col(rides), F.sum(rides).over(window), digits)


def scaled(
    value: str, low: float, high: float, group: Sequence[str | Column] = ()
) -> Column:
    """``value`` mapped linearly from its range in the group to low..high.

    NULL if the group has a single value. For results that are already cut to k rows.
    """
    window = Window.partitionBy(*(group or [F.lit(0)]))
    least, most = F.min(value).over(window), F.max(value).over(window)
    return low + F.try_divide(F.col(value) - least, most - least) * F.lit(high - low)


def long_counts(frame: DataFrame, dimensions: dict[str, str]) -> DataFrame:
    """Rides per value of each dimension, as rows (dimension, value, rides).

    The rides are counted once at the joint grain of all dimensions, and only those few
    rows are multiplied by the number of dimensions.
    """
    grain = frame.groupBy(*dimensions.values()).agg(rides("n"))
    pairs = [
        F.struct(F.lit(name).alias("dimension"), F.col(column).cast("string").alias("value"))
        for name, column in dimensions.items()
    ]
    return (
        grain.select("n", F.explode(F.array(*pairs)).alias("pair"))
        .groupBy("pair.dimension", "pair.value")
        .agg(F.sum("n").alias("rides"))
    )
