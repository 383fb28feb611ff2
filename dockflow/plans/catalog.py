"""All queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

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

QUERIES: dict[str, Callable[..., DataFrame]] = {
    query.__name__: query
    for query in (
        stations.station_starts_monthly,
        stations.station_ends_monthly,
        stations.station_month_topk,
        stations.station_alltime_topk,
        stations.station_end_heavy_latest,
        stations.station_top_starts_named,
        stations.station_map_points,
        bikes.bike_type_monthly,
        bikes.bike_type_monthly_summary,
        bikes.bike_type_latest_month,
        bikes.bike_type_at_periods,
        users.user_hourly,
        users.user_daily,
        users.user_weekend,
        users.user_overall,
        users.user_day_pivot,
        users.user_hour_pivot,
        users.user_avg_duration,
        peaks.peak_hours_by_season,
        peaks.peak_hours_simple,
        peaks.peak_hours_nested,
        peaks.peak_hour_table,
        peaks.season_peak_hour,
        peaks.hourly_rides_per_day,
        growth.monthly_rides,
        growth.monthly_rides_by_user,
        growth.monthly_rides_by_user_nested,
        growth.yoy_monthly,
        growth.yoy_totals,
        growth.yoy_same_month,
        growth.monthly_volume_by_file,
        durations.duration_by_bike,
        durations.duration_by_bike_user,
        durations.duration_percentiles,
        durations.duration_sketch_by_bike,
        durations.duration_sketch_by_bike_user,
        durations.duration_sketch_rollup,
        durations.duration_by_bike_exact,
        durations.duration_describe,
        durations.duration_histogram,
        durations.duration_box_by_bike,
        long_rides.long_ride_summary,
        long_rides.long_ride_describe,
        long_rides.long_ride_split,
        long_rides.user_share,
        long_rides.long_ride_histogram,
        long_rides.long_ride_rate_by_user,
        long_rides.long_ride_circular_share,
        routes.route_counts,
        routes.top_routes_oneway,
        routes.top_routes_circular,
        routes.asymmetric_routes,
        routes.top_routes_labelled,
        routes.top_routes_geo,
        seasons.season_volume,
        seasons.season_duration,
        seasons.season_bike_mix,
        seasons.season_user_mix,
        seasons.season_by_year,
        seasons.season_by_year_nested,
        seasons.season_electric_share,
        seasons.season_casual_share,
        circular.circular_overall,
        circular.circular_by_user,
        circular.circular_duration,
        circular.circular_top_count,
        circular.circular_top_rate,
        circular.circular_station_share,
        circular.circular_split,
        circular.circular_user_share,
        circular.circular_histogram,
        circular.circular_box,
        recommend.station_hour_starts,
        recommend.station_hour_ends,
        recommend.station_net_inflow,
        recommend.recommend_best,
        recommend.recommend_top5,
        recommend.recommend_at,
        recommend.net_inflow_topk,
        overview.overview_counts,
        overview.overview_mix,
        overview.overview_duration,
        overview.load_profile,
        overview.file_row_faults,
        overview.file_selection,
        overview.file_load_plan,
    )
}
