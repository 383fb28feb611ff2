"""Popular stations and their balance of departures and arrivals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.clock import month_label
from dockflow.functions.trip import bounded, count_where, positive, rides
from dockflow.operators.flows import station_flows
from dockflow.operators.ranking import by_name, few, top, top_per_group
from dockflow.operators.shares import scaled


def _months() -> dict[str, Column]:
    """Arrivals are booked in the month the ride began."""
    return {name: F.col(name).cast("bigint") for name in ("year", "month")}


def station_starts_monthly(trips: DataFrame) -> DataFrame:
    station = F.col("start_station_name").alias("station")
    months = [column.alias(name) for name, column in _months().items()]
    return bounded(trips).groupBy(station, *months).agg(rides("start_count"))


def station_ends_monthly(trips: DataFrame) -> DataFrame:
    station = F.col("end_station_name").alias("station")
    months = [column.alias(name) for name, column in _months().items()]
    return bounded(trips).groupBy(station, *months).agg(rides("end_count"))


def _month() -> dict[str, Column]:
    return {"month_no": F.col("month_no")}


def _label() -> Column:
    return month_label(F.col("month_no")).alias("ym")


def _balance() -> list[Column]:
    return [
        "station",
        F.col("starts").alias("start_count"),
        F.col("ends").alias("end_count"),
        (F.col("ends") - F.col("starts")).alias("net"),
    ]


def station_month_topk(trips: DataFrame, k: int = 20) -> DataFrame:
    """The k busiest start stations of every month, with the arrivals there."""
    monthly = station_flows(bounded(trips), _month()).filter("starts > 0")
    busiest = top_per_group(monthly, ["month_no"], k, F.desc("starts"), *by_name("station"))
    return busiest.select(_label(), *_balance())


def station_alltime_topk(trips: DataFrame, k: int = 30) -> DataFrame:
    totals = station_flows(bounded(trips)).filter("starts > 0")
    busiest = top(totals, k, F.desc("starts"), *by_name("station"))
    return busiest.select(
        "station", F.col("starts").alias("rides"), F.col("ends").alias("end_count")
    )


def station_end_heavy_latest(trips: DataFrame, k: int = 5, among: int = 20) -> DataFrame:
    """Of the busiest stations of the latest month, those with the largest surplus of arrivals.

    The month is found first, as a scalar subquery over the calendar columns alone, so that on
    the stored table only that month's partition is read for the counts.
    """
    usable = bounded(trips)
    latest = usable.agg(F.max("month_no")).scalar()
    month = station_flows(usable.filter(F.col("month_no") == latest), _month())
    busiest = top(month.filter("starts > 0"), among, F.desc("starts"), *by_name("station"))
    balanced = busiest.select(_label(), *_balance()).withColumn(
        "direction",
        F.when(F.col("net") > 0, "ends > starts").otherwise("starts > ends"),
    )
    return top(balanced, k, F.desc("net"), F.desc("start_count"), *by_name("station"))


def station_top_starts_named(trips: DataFrame, k: int = 15) -> DataFrame:
    named = positive(trips).filter(F.col("start_station_name").isNotNull())
    counts = named.groupBy(F.col("start_station_name").alias("station")).agg(rides())
    return top(counts, k, F.desc("rides"), *by_name("station"))


def station_map_points(trips: DataFrame, k: int = 40) -> DataFrame:
    """The k busiest start stations with a position and a marker radius of 5 to 30.

    The position is that of the earliest ride that has one; of several at that moment, the
    southernmost. It is looked up among the rides of the k stations at that moment, so that
    the counts are kept in fixed-width numbers and need no sorting of the trips. The lookup names
    the months, so that on the stored table it reads the partitions of those moments alone.
    """
    named = positive(trips).filter(F.col("start_station_name").isNotNull())
    located = F.col("start_lat").isNotNull() & F.col("start_lng").isNotNull()
    counts = named.groupBy(F.col("start_station_name").alias("station")).agg(
        count_where(F.col("has_ride_id"), "rides"),
        F.min(F.when(located, F.col("started_at"))).alias("first_at"),
    )
    busiest = top(counts, k, F.desc("rides"), *by_name("station"))
    moments = busiest.select(
        F.col("station").alias("place"),
        F.col("first_at").alias("moment"),
        F.year("first_at").alias("in_year"),
        F.month("first_at").alias("in_month"),
    )
    at_first = (
        (F.col("start_station_name") == F.col("place"))
        & (F.col("started_at") == F.col("moment"))
        & (F.col("year") == F.col("in_year"))
        & (F.col("month") == F.col("in_month"))
    )
    places = (
        named.filter(located)
        .join(few(moments, k), at_first)
        .groupBy("place", "moment")
        .agg(F.min(F.struct("start_lat", "start_lng")).alias("at"))
    )
    # Joining on the moment as well keeps both uses of the counts alike, so they share one.
    found = (F.col("station") == F.col("place")) & (F.col("first_at") == F.col("moment"))
    return busiest.join(few(places, k), found, "left").select(
        "station",
        "rides",
        F.col("at.start_lat").alias("lat"),
        F.col("at.start_lng").alias("lng"),
        scaled("rides", 5, 30).alias("radius"),
    )
