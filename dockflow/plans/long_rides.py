"""Rides that are suspiciously long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.clock import day_name
from dockflow.functions.figures import MICROS_PER_MINUTE, MICROS_PER_SECOND, percent
from dockflow.functions.trip import count_where, positive, rides
from dockflow.operators.histogram import range_histogram
from dockflow.operators.shares import long_counts, share_of
from dockflow.plans.durations import describe

LONG_MINUTES = 1000
DAY_MINUTES = 1440
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE


def _over(minutes: int) -> Column:
    return F.col("duration_us") > minutes * MICROS_PER_MINUTE


def long_ride_summary(trips: DataFrame, minutes: int = LONG_MINUTES) -> DataFrame:
    counts = positive(trips).agg(
        count_where(_over(minutes), "long_rides"),
        rides("all_rides"),
        count_where(_over(DAY_MINUTES), "over_a_day"),
    )
    return counts.withColumn("pct_long", percent(F.col("long_rides"), F.col("all_rides"), 2))


def long_ride_describe(trips: DataFrame, minutes: int = LONG_MINUTES) -> DataFrame:
    """In seconds."""
    return describe(positive(trips).filter(_over(minutes)), MICROS_PER_SECOND)


def long_ride_split(trips: DataFrame, minutes: int = LONG_MINUTES) -> DataFrame:
    """Long rides by user type, bike type, weekday and start hour, as long rows."""
    long_ones = positive(trips).filter(_over(minutes))
    dimensions = {"user": "member_casual", "bike": "rideable_type", "day": "day", "hour": "hour"}
    return long_counts(long_ones.withColumn("day", day_name(F.col("dow"))), dimensions).filter(
        F.col("value").isNotNull()
    )


def user_share(trips: DataFrame) -> DataFrame:
    """A ride without a user type is in no share, nor in the whole."""
    named = positive(trips).filter(F.col("member_casual").isNotNull())
    counts = named.groupBy("member_casual").agg(rides())
    return counts.withColumn("pct", share_of("rides"))


def long_ride_histogram(
    trips: DataFrame, minutes: int = LONG_MINUTES, bins: int = 40
) -> DataFrame:
    """In hours."""
    long_ones = positive(trips).filter(_over(minutes))
    return range_histogram(long_ones, F.col("duration_us"), bins, MICROS_PER_HOUR)


def long_ride_rate_by_user(trips: DataFrame, minutes: int = LONG_MINUTES) -> DataFrame:
    counts = (
        positive(trips)
        .groupBy("member_casual")
        .agg(count_where(_over(minutes), "long_rides"), rides("all_rides"))
    )
    return counts.withColumn("pct_long", percent(F.col("long_rides"), F.col("all_rides"), 2))


def long_ride_circular_share(trips: DataFrame, minutes: int = LONG_MINUTES) -> DataFrame:
    """Share of circular rides among long rides and among all; every other ride is one-way."""
    totals = positive(trips).agg(
        *[
            F.struct(
                F.lit(name).alias("population"),
                count_where(among, "rides"),
                count_where(among & F.col("is_circular"), "circular"),
            ).alias(name)
            for name, among in {"long": _over(minutes), "all": F.lit(True)}.items()
        ]
    )
    rows = totals.select(F.inline(F.array("long", "all")))
    return rows.select(
        "population",
        "rides",
        "circular",
        percent(F.col("circular"), F.col("rides")).alias("circular_pct"),
        percent(F.col("rides") - F.col("circular"), F.col("rides")).alias("one_way_pct"),
    )
