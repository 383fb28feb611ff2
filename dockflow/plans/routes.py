"""Routes from station to station."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.figures import percent
from dockflow.functions.trip import count_where, positive, rides, started
from dockflow.operators.heavy import busiest_groups
from dockflow.operators.ranking import by_name, top
from dockflow.operators.shares import scaled

START, END = "start_station_name", "end_station_name"
ENDPOINTS = ("start_lat", "start_lng", "end_lat", "end_lng")


def route_counts(trips: DataFrame) -> DataFrame:
    """Rides per station pair; a pair with an unnamed station is neither circular nor not."""
    counts = started(trips).groupBy(START, END, "is_circular").agg(rides())
    return counts.select(START, END, "rides", "is_circular")


def top_routes_oneway(trips: DataFrame, k: int = 50) -> DataFrame:
    counts = route_counts(trips).filter(~F.col("is_circular"))
    named = counts.select(F.col(START).alias("from"), F.col(END).alias("to"), "rides")
    return top(named, k, F.desc("rides"), *by_name("from", "to"))


def top_routes_circular(trips: DataFrame, k: int = 30) -> DataFrame:
    counts = route_counts(trips).filter(F.col("is_circular"))
    named = counts.select(F.col(START).alias("station"), "rides")
    return top(named, k, F.desc("rides"), *by_name("station"))


def asymmetric_routes(trips: DataFrame, min_rides: int = 1000, k: int = 15) -> DataFrame:
    """Station pairs busy in both directions, the most one-sided directions first.

    Both directions of a pair are counted in one group, so there is no self-join: one scan,
    one shuffle, and each surviving pair gives its two directions.
    """
    oneway = started(trips).filter(~F.col("is_circular"))
    pairs = oneway.groupBy(
        F.least(START, END).alias("first"), F.greatest(START, END).alias("second")
    ).agg(
        count_where(F.col(START) < F.col(END), "forth"),
        count_where(F.col(START) > F.col(END), "back"),
    )
    busy = pairs.filter((F.col("forth") > min_rides) & (F.col("back") > min_rides))

    def direction(a: str, b: str, out: str, home: str) -> Column:
        return F.struct(
            F.col(a).alias("station_a"),
            F.col(b).alias("station_b"),
            F.col(out).alias("a_to_b"),
            F.col(home).alias("b_to_a"),
            percent(F.col(out), F.col(out) + F.col(home)).alias("asymmetry_pct"),
        )

    directions = busy.select(
        F.inline(
            F.array(
                direction("first", "second", "forth", "back"),
                direction("second", "first", "back", "forth"),
            )
        )
    )
    return top(directions, k, F.desc("asymmetry_pct"), *by_name("station_a", "station_b"))


def top_routes_labelled(trips: DataFrame, k: int = 15) -> DataFrame:
    named = positive(trips).filter(F.col("is_circular").isNotNull())
    counts = named.groupBy(START, END, "is_circular").agg(rides())
    busiest = top(counts, k, F.desc("rides"), *by_name(START, END))
    label = F.concat_ws("  →  ", START, END)
    return busiest.select(START, END, "rides", "is_circular", label.alias("label"))


def top_routes_geo(trips: DataFrame, k: int = 20) -> DataFrame:
    """The busiest routes between exact positions, with a size to draw them.

    ``size`` is a line width of 1 to 6 for a one-way route and a marker radius of 6 to 26 for
    a circular one, scaled among the routes of its kind. Positions may differ in every ride, so
    rides that can't be on one of the k routes are left out before the grouping.
    """
    located = positive(trips).dropna(subset=[START, END, *ENDPOINTS])
    route = [START, END, *ENDPOINTS]
    busiest = busiest_groups(located, [*route, "is_circular"], k, *by_name(*route))
    size = F.when(F.col("is_circular"), scaled("rides", 6, 26, ["is_circular"])).otherwise(
        scaled("rides", 1, 6, ["is_circular"])
    )
    return busiest.select(START, END, *ENDPOINTS, "rides", "is_circular", size.alias("size"))
