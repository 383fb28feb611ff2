"""Rides that end where they began."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.figures import (
    MICROS_PER_MINUTE,
    mean_minutes,
    percent,
    seconds_as_minutes,
)
from dockflow.functions.trip import (
    CIRCULAR,
    ONE_WAY,
    count_where,
    positive,
    rides,
    valid,
)
from dockflow.operators.box import box_statistics
from dockflow.operators.histogram import fixed_histogram
from dockflow.operators.quantiles import second_profile
from dockflow.operators.ranking import by_name, top
from dockflow.operators.shares import share_of


def _circular(name: str = "circular_rides") -> Column:
    return count_where(F.col("is_circular"), name)


def _pct(digits: int) -> Column:
    return percent(F.col("circular_rides"), F.col("total_rides"), digits).alias("pct_circular")


def _two_kinds(trips: DataFrame) -> DataFrame:
    """Rides known to be circular or one-way, under ``label``."""
    kinds = positive(trips).withColumn("label", F.col("route_kind"))
    return kinds.filter(F.col("label").isin(CIRCULAR, ONE_WAY))


def circular_overall(trips: DataFrame) -> DataFrame:
    return valid(trips).agg(rides("total_rides"), _circular()).select("*", _pct(2))


def circular_by_user(trips: DataFrame) -> DataFrame:
    counts = valid(trips).groupBy("member_casual").agg(rides("total_rides"), _circular())
    return counts.select("*", _pct(2))


def circular_duration(trips: DataFrame) -> DataFrame:
    """Circular, one-way and unknown (a station without name) rides compared."""
    profile = second_profile(valid(trips), ["route_kind"], {"median": 0.5, "p95": 0.95})
    return profile.select(
        F.col("route_kind").alias("label"),
        "rides",
        mean_minutes(F.col("total_secs"), F.col("rides")).alias("avg_min"),
        seconds_as_minutes(F.col("median")).alias("median_min"),
        seconds_as_minutes(F.col("p95")).alias("p95_min"),
    )


def circular_top_count(trips: DataFrame, k: int = 20) -> DataFrame:
    station = F.col("start_station_name").alias("station")
    counts = valid(trips).filter("is_circular").groupBy(station).agg(rides("circular_rides"))
    return top(counts, k, F.desc("circular_rides"), *by_name("station"))


def circular_top_rate(trips: DataFrame, min_rides: int = 500, k: int = 20) -> DataFrame:
    """Stations with enough rides by their share of circular ones."""
    station = F.col("start_station_name").alias("station")
    counts = valid(trips).groupBy(station).agg(rides("total_rides"), _circular())
    busy = counts.filter(F.col("total_rides") > min_rides).select("*", _pct(1))
    return top(busy, k, F.desc("pct_circular"), *by_name("station"))


def circular_station_share(trips: DataFrame, k: int = 10) -> DataFrame:
    """The stations with most circular rides, and the share of those among all starts there."""
    station = F.col("start_station_name").alias("station")
    counts = positive(trips).groupBy(station).agg(rides("total_rides"), _circular())
    busiest = top(
        counts.filter(F.col("circular_rides") > 0),
        k,
        F.desc("circular_rides"),
        *by_name("station"),
    )
    return busiest.select("*", _pct(1))


def circular_split(trips: DataFrame) -> DataFrame:
    counts = positive(trips).groupBy(F.col("route_kind").alias("label")).agg(rides())
    return counts.withColumn("pct", share_of("rides"))


def circular_user_share(trips: DataFrame) -> DataFrame:
    """User types among circular rides, next to user types among all rides.

    A ride without a user type is in no share, nor in the whole.
    """
    named = positive(trips).filter(F.col("member_casual").isNotNull())
    counts = named.groupBy("member_casual").agg(_circular(), rides("total_rides"))
    return counts.select(
        "member_casual",
        share_of("circular_rides").alias("circular_pct"),
        share_of("total_rides").alias("overall_pct"),
    )


def circular_histogram(trips: DataFrame, bins: int = 59, upto: int = 90) -> DataFrame:
    """Minutes in equal bins from 0; longer rides are not counted."""
    return fixed_histogram(
        _two_kinds(trips),
        F.col("duration_us"),
        bins,
        0,
        upto * MICROS_PER_MINUTE,
        MICROS_PER_MINUTE,
        ["label"],
    )


def circular_box(trips: DataFrame, cap: int = 90) -> DataFrame:
    capped = F.least(F.col("duration_us"), F.lit(cap * MICROS_PER_MINUTE))
    return box_statistics(_two_kinds(trips), "label", capped, MICROS_PER_MINUTE)
