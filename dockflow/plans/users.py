"""Members and casual riders: when they ride and for how long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.clock import day_name
from dockflow.functions.figures import (
    MICROS_PER_MINUTE,
    exact_sum,
    mean_minutes,
    ratio,
    seconds_as_minutes,
)
from dockflow.functions.trip import CASUAL, MEMBER, count_where, positive, rides, valid
from dockflow.operators.axis import on_axis
from dockflow.operators.quantiles import second_profile


def _mean() -> Column:
    return mean_minutes(F.sum("total_secs"), F.sum("n")).alias("avg_duration_min")


def _by_user() -> list[Column]:
    user = F.col("member_casual")
    other = user.isNull() | ~user.isin(MEMBER, CASUAL)
    return [
        count_where(user == MEMBER, "member"),
        count_where(user == CASUAL, "casual"),
        count_where(other, "other"),
    ]


def user_hourly(trips: DataFrame) -> DataFrame:
    hour = F.col("hour").cast("bigint").alias("hour")
    return valid(trips).groupBy("member_casual", hour).agg(rides(), _mean())


def user_daily(trips: DataFrame) -> DataFrame:
    dow = F.col("dow").cast("bigint").alias("dow")
    counts = valid(trips).groupBy("member_casual", dow).agg(rides())
    return counts.select("member_casual", "dow", day_name(F.col("dow")).alias("day"), "rides")


def user_weekend(trips: DataFrame) -> DataFrame:
    when = F.col("day_class").alias("is_weekend")
    return valid(trips).groupBy("member_casual", when).agg(rides(), _mean())


def user_overall(trips: DataFrame) -> DataFrame:
    profile = second_profile(valid(trips), ["member_casual"], {"median": 0.5})
    return profile.select(
        "member_casual",
        F.col("rides").alias("total_rides"),
        mean_minutes(F.col("total_secs"), F.col("rides")).alias("avg_duration_min"),
        seconds_as_minutes(F.col("median")).alias("median_duration_min"),
    )


def user_day_pivot(trips: DataFrame) -> DataFrame:
    counts = valid(trips).groupBy(F.col("dow").cast("bigint").alias("dow")).agg(*_by_user())
    week = on_axis(counts, "dow", 1, 7)
    short = F.substring(day_name(F.col("dow")), 1, 3)
    return week.select("dow", short.alias("day"), "member", "casual", "other")


def user_hour_pivot(trips: DataFrame) -> DataFrame:
    hour = F.col("hour").cast("bigint").alias("hour")
    return positive(trips).groupBy(hour).agg(*_by_user())


def user_avg_duration(trips: DataFrame) -> DataFrame:
    """Mean minutes, not rounded."""
    mean = ratio(exact_sum(F.col("total_us")), F.sum("n"), MICROS_PER_MINUTE)
    return positive(trips).groupBy("member_casual").agg(mean.alias("avg_duration_min"))
