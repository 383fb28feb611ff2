"""Adoption of electric bikes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.clock import month_label
from dockflow.functions.figures import percent
from dockflow.functions.trip import CLASSIC, ELECTRIC, count_where, rides, started


def _label() -> Column:
    return month_label(F.col("month_no")).alias("ym")


def _both_types() -> list[Column]:
    bike = F.col("rideable_type")
    return [count_where(bike == CLASSIC, "classic"), count_where(bike == ELECTRIC, "electric")]


def bike_type_monthly(trips: DataFrame) -> DataFrame:
    types = ["rideable_type", "member_casual"]
    counts = started(trips).groupBy("month_no", *types).agg(rides())
    return counts.select(_label(), *types, "rides")


def bike_type_monthly_summary(trips: DataFrame) -> DataFrame:
    """The electric share is one of all rides, whatever their type."""
    months = started(trips).groupBy("month_no").agg(rides("total_rides"), *_both_types())
    return months.select(
        _label(),
        "total_rides",
        "classic",
        "electric",
        percent(F.col("electric"), F.col("total_rides")).alias("pct_electric"),
    )


def bike_type_latest_month(trips: DataFrame) -> DataFrame:
    """The month is the largest number; a trip without a readable start has none.

    On the stored table it is found in the partition names, and only its partition is read.
    """
    latest = trips.agg(F.max("month_no")).scalar()
    return bike_type_monthly(trips.filter(F.col("month_no") == latest))


def bike_type_at_periods(
    trips: DataFrame, periods: Sequence[str] = ("202301", "202306", "202401", "202406")
) -> DataFrame:
    """Every row of the named monthly files; the electric share is one of the two types."""
    chosen = trips.filter(F.col("file_period").isin(*periods))
    counts = chosen.groupBy(F.col("file_period").alias("period")).agg(*_both_types())
    return counts.withColumn(
        "pct_electric", percent(F.col("electric"), F.col("classic") + F.col("electric"))
    )
