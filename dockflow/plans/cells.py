"""Cells: all rides counted once at the finest grain of a family of queries.

A calendar cell holds the rides of one month, weekday, hour, bike type, user type, route kind and
population; a duration cell those of one whole second, bike type, user type, season and route
kind; a pair cell those between two stations; a flow cell the departures or arrivals of one
station, month and hour. Their numbers are bounded by the calendar, the seconds of a day and the
stations, not by the rides. A query gives the same answer on the cells it is listed with as on the
trips, so that reports read the trips once per kind of cell.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.figures import exact_sum
from dockflow.functions.trip import bounded, rides, valid, with_labels
from dockflow.plans import (
    bikes,
    circular,
    durations,
    growth,
    long_rides,
    overview,
    peaks,
    recommend,
    routes,
    seasons,
    stations,
    users,
)

GRAIN = (
    "year",
    "month",
    "dow",
    "hour",
    "rideable_type",
    "member_casual",
    "is_circular",
    "is_started",
    "is_valid",
    "is_positive",
)

FROM_CELLS = frozenset(
    query.__name__
    for query in (
        bikes.bike_type_monthly,
        bikes.bike_type_monthly_summary,
        bikes.bike_type_latest_month,
        users.user_hourly,
        users.user_daily,
        users.user_weekend,
        users.user_day_pivot,
        users.user_hour_pivot,
        users.user_avg_duration,
        peaks.peak_hours_by_season,
        peaks.peak_hours_simple,
        peaks.peak_hours_nested,
        peaks.season_hours,
        peaks.peak_hour_table,
        peaks.season_peak_hour,
        growth.monthly_rides,
        growth.monthly_rides_by_user,
        growth.monthly_rides_by_user_nested,
        growth.yoy_monthly,
        growth.yoy_totals,
        long_rides.user_share,
        seasons.season_volume,
        seasons.season_bike_mix,
        seasons.season_user_mix,
        seasons.season_by_year,
        seasons.season_by_year_nested,
        seasons.season_electric_share,
        seasons.season_casual_share,
        circular.circular_overall,
        circular.circular_by_user,
        circular.circular_split,
        circular.circular_user_share,
        overview.overview_mix,
    )
)


def calendar_cells(trips: DataFrame) -> DataFrame:
    """One scan, one shuffle of map-side combined cells."""
    cells = trips.groupBy(*GRAIN).agg(
        rides("n"),
        F.sum("total_secs").alias("total_secs"),
        exact_sum(F.col("total_us")).alias("total_us"),
    )
    return with_labels(cells)


def duration_cells(trips: DataFrame) -> DataFrame:
    grain = ("rideable_type", "member_casual", "season", "route_kind", "is_valid", "duration_secs")
    return valid(trips).groupBy(*grain).agg(rides("n"), F.sum("total_secs").alias("total_secs"))


def pair_cells(trips: DataFrame) -> DataFrame:
    grain = ("start_station_name", "end_station_name", "is_circular", "is_started", "is_valid")
    return trips.groupBy(*grain).agg(rides("n"))


def flow_cells(trips: DataFrame) -> DataFrame:
    """Both halves of every bounded ride; ``hour`` and ``end_hour`` are the hour of the half."""

    def half(station: str, is_start: bool, hour: str) -> Column:
        return F.struct(
            F.col(station).alias("station"),
            F.lit(is_start).alias("is_start"),
            "month_no",
            F.col(hour).alias("hour"),
            F.col(hour).alias("end_hour"),
            "is_bounded",
            "is_named",
            "n",
        )

    halves = [half("start_station_name", True, "hour"), half("end_station_name", False, "end_hour")]
    events = bounded(trips).select(F.inline(F.array(*halves)))
    grain = [name for name in events.columns if name != "n"]
    return events.groupBy(*grain).agg(rides("n"))


def _names(*queries: Callable) -> frozenset[str]:
    return frozenset(query.__name__ for query in queries)


#: Each kind of cells, and the queries that can be asked of it.
CELLS: dict[str, tuple[Callable[[DataFrame], DataFrame], frozenset[str]]] = {
    "calendar_cells": (calendar_cells, FROM_CELLS),
    "duration_cells": (
        duration_cells,
        _names(
            users.user_overall,
            durations.duration_by_bike,
            durations.duration_by_bike_user,
            durations.duration_percentiles,
            durations.duration_by_bike_exact,
            seasons.season_duration,
            circular.circular_duration,
        ),
    ),
    "pair_cells": (
        pair_cells,
        _names(
            routes.route_counts,
            routes.top_routes_oneway,
            routes.top_routes_circular,
            routes.asymmetric_routes,
            circular.circular_top_count,
            circular.circular_top_rate,
        ),
    ),
    "flow_cells": (
        flow_cells,
        _names(
            stations.station_month_topk,
            stations.station_alltime_topk,
            recommend.station_net_inflow,
            recommend.recommend_best,
            recommend.recommend_top5,
            recommend.recommend_at,
        ),
    ),
}
