"""Where a bike is likely to be found at a given hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.trip import bounded_named, positive, rides
from dockflow.operators.flows import station_flows
from dockflow.operators.ranking import by_name, top_per_group

RESULT = ("station", "score", "starts", "ends")


def _start_hour() -> Column:
    return F.col("hour").cast("bigint")


def _end_hour() -> Column:
    return F.col("end_hour").cast("bigint")


def station_hour_starts(trips: DataFrame) -> DataFrame:
    station = F.col("start_station_name").alias("station")
    return bounded_named(trips).groupBy(_start_hour().alias("hour"), station).agg(rides("starts"))


def station_hour_ends(trips: DataFrame) -> DataFrame:
    station = F.col("end_station_name").alias("station")
    return bounded_named(trips).groupBy(_end_hour().alias("hour"), station).agg(rides("ends"))


def _inflow(trips: DataFrame, min_activity: int) -> DataFrame:
    """Departures under their own hour, arrivals under theirs."""
    flows = station_flows(trips, {"hour": _start_hour()}, {"hour": _end_hour()})
    active = flows.filter(F.col("starts") + F.col("ends") > min_activity)
    return active.withColumn("score", F.col("ends") - F.col("starts"))


def station_net_inflow(trips: DataFrame, min_activity: int = 20) -> DataFrame:
    return _inflow(bounded_named(trips), min_activity).select(
        "hour", "station", "starts", "ends", "score"
    )


def _ranked(trips: DataFrame, min_activity: int, k: int) -> DataFrame:
    inflow = station_net_inflow(trips, min_activity)
    best = top_per_group(inflow, ["hour"], k, F.desc("score"), *by_name("station"))
    return best.select("hour", "rank", *RESULT)


def recommend_best(trips: DataFrame, min_activity: int = 20) -> DataFrame:
    return _ranked(trips, min_activity, 1).drop("rank")


def recommend_top5(trips: DataFrame, min_activity: int = 20) -> DataFrame:
    return _ranked(trips, min_activity, 5)


def recommend_at(trips: DataFrame, hour: int, min_activity: int = 20) -> DataFrame:
    """The five best stations at one hour, and what to expect there.

    Only trips that begin or end in that hour are counted.
    """
    if not 0 <= hour <= 23:
        raise ValueError(f"hour must be 0 to 23, not {hour}")
    near = trips.filter((F.col("hour") == hour) | (F.col("end_hour") == hour))
    best = recommend_top5(near, min_activity).filter(F.col("hour") == hour)
    return best.withColumn(
        "outlook", F.when(F.col("score") > 0, "accumulate").otherwise("scarce")
    )


def net_inflow_topk(
    trips: DataFrame, hours: Sequence[int] = (8, 17), min_activity: int = 50, k: int = 10
) -> DataFrame:
    """Stations with the largest surplus of arrivals at some hours; unnamed ones left out."""
    near = positive(trips).filter(F.col("hour").isin(*hours) | F.col("end_hour").isin(*hours))
    inflow = _inflow(near, min_activity).filter(
        F.col("station").isNotNull() & F.col("hour").isin(*hours)
    )
    best = top_per_group(inflow, ["hour"], k, F.desc("score"), *by_name("station"))
    return best.select(
        "hour",
        "station",
        F.col("score").alias("net_inflow"),
        (F.col("starts") + F.col("ends")).alias("total_activity"),
        "starts",
        "ends",
    )
