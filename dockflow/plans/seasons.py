"""What the season does to riding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.figures import mean_minutes, percent, seconds_as_minutes
from dockflow.functions.trip import (
    CASUAL,
    CLASSIC,
    ELECTRIC,
    MEMBER,
    count_where,
    rides,
    valid,
)
from dockflow.operators.nested import keyed
from dockflow.operators.quantiles import second_profile


def season_volume(trips: DataFrame) -> DataFrame:
    return valid(trips).groupBy("season").agg(rides())


def season_duration(trips: DataFrame) -> DataFrame:
    profile = second_profile(valid(trips), ["season"], {"median": 0.5, "p95": 0.95})
    return profile.select(
        "season",
        mean_minutes(F.col("total_secs"), F.col("rides")).alias("avg_min"),
        seconds_as_minutes(F.col("median")).alias("median_min"),
        seconds_as_minutes(F.col("p95")).alias("p95_min"),
    )


def season_bike_mix(trips: DataFrame) -> DataFrame:
    return valid(trips).groupBy("season", "rideable_type").agg(rides())


def season_user_mix(trips: DataFrame) -> DataFrame:
    return valid(trips).groupBy("season", "member_casual").agg(rides())


def season_by_year(trips: DataFrame) -> DataFrame:
    return valid(trips).groupBy(F.col("year").cast("bigint").alias("year"), "season").agg(rides())


def season_by_year_nested(trips: DataFrame) -> DataFrame:
    """Rides of every season of a year as one JSON object."""
    years = season_by_year(trips).groupBy("year").agg(
        keyed(F.col("season"), F.col("rides")).alias("seasons")
    )
    return years.withColumn("seasons", F.to_json("seasons"))


def _pct(part: str, other: str) -> Column:
    share = percent(F.col(part), F.col(part) + F.col(other))
    return F.coalesce(share, F.lit(0.0)).alias(f"pct_{part}")


def season_electric_share(trips: DataFrame) -> DataFrame:
    bike = F.col("rideable_type")
    counts = (
        valid(trips)
        .groupBy("season")
        .agg(count_where(bike == CLASSIC, "classic"), count_where(bike == ELECTRIC, "electric"))
    )
    return counts.select("season", "classic", "electric", _pct("electric", "classic"))


def season_casual_share(trips: DataFrame) -> DataFrame:
    user = F.col("member_casual")
    counts = (
        valid(trips)
        .groupBy("season")
        .agg(count_where(user == MEMBER, "member"), count_where(user == CASUAL, "casual"))
    )
    return counts.select(
        "season", "member", "casual", _pct("casual", "member"), _pct("member", "casual")
    )
