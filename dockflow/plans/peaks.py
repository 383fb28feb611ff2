"""Peak hours on weekdays and weekends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.trip import count_where, positive, rides, started
from dockflow.operators.axis import on_axis
from dockflow.operators.nested import ordered_list


def _hour() -> Column:
    return F.col("hour").cast("bigint").alias("hour")


def _day_class() -> Column:
    return F.col("day_class").alias("is_weekend")


def peak_hours_by_season(trips: DataFrame) -> DataFrame:
    return started(trips).groupBy(_hour(), _day_class(), "season").agg(rides())


def peak_hours_simple(trips: DataFrame) -> DataFrame:
    return started(trips).groupBy(_hour(), _day_class()).agg(rides())


def season_hours(trips: DataFrame) -> DataFrame:
    """The hours of each day class and season as one list, in order."""
    hours = ordered_list([F.col("hour")], F.struct("hour", "rides"))
    counts = peak_hours_by_season(trips)
    return counts.groupBy("is_weekend", "season").agg(hours.alias("hours"))


def peak_hours_nested(trips: DataFrame) -> DataFrame:
    return season_hours(trips).withColumn("hours", F.to_json("hours"))


def peak_hour_table(trips: DataFrame) -> DataFrame:
    counts = (
        started(trips)
        .groupBy(_hour())
        .agg(
            count_where(F.col("day_class") == "weekday", "weekday"),
            count_where(F.col("day_class") == "weekend", "weekend"),
        )
    )
    return on_axis(counts, "hour", 0, 23)


def season_peak_hour(trips: DataFrame) -> DataFrame:
    """The busiest weekday hour of every season; the earlier one on a tie."""
    weekdays = peak_hours_by_season(trips.filter(F.col("day_class") == "weekday"))
    busiest = F.max(F.struct("rides", (-F.col("hour")).alias("early")))
    seasons = weekdays.groupBy("season").agg(
        busiest.alias("peak"), F.sum("rides").alias("total_rides")
    )
    return seasons.select(
        "season",
        (-F.col("peak.early")).alias("peak_hour"),
        F.col("peak.rides").alias("peak_rides"),
        "total_rides",
    )


def hourly_rides_per_day(trips: DataFrame) -> DataFrame:
    """Mean rides per day for every hour, over the weekdays and weekend days that occur.

    Rides are counted by date and hour once; the number of days comes out of those counts.
    """
    daily = (
        positive(trips)
        .groupBy(F.col("started_at").cast("date").alias("date"), _hour(), _day_class())
        .agg(rides())
    )
    kinds = ("weekday", "weekend")

    def of(kind: str, column: str) -> Column:
        # Reads the rides for the days too, so that both uses share one set of counts.
        return F.when((F.col("is_weekend") == kind) & (F.col("rides") > 0), F.col(column))

    days = daily.agg(
        F.struct(*[F.count_distinct(of(kind, "date")).alias(kind) for kind in kinds])
    ).scalar()
    hours = daily.groupBy("hour").agg(
        *[F.coalesce(F.sum(of(kind, "rides")), F.lit(0)).alias(kind) for kind in kinds]
    )
    per_day = [
        F.try_divide(F.col(kind), F.col(f"days.{kind}")).alias(f"{kind}_per_day")
        for kind in kinds
    ]
    return hours.withColumn("days", days).select("hour", *per_day)
