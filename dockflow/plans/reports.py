"""The eleven result documents."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.operators.nested import (
    document,
    list_of,
    map_of,
    map_of_lists,
    map_of_maps,
    single,
)
from dockflow.plans.catalog import QUERIES
from dockflow.plans.cells import CELLS
from dockflow.plans.peaks import season_hours
from dockflow.sources.results import together, write_result

Run = Callable[[str], DataFrame]

SECTIONS = {**QUERIES, "season_hours": season_hours}


def _down(name: str) -> Column:
    return -F.col(name)


def _named(name: str) -> list[Column]:
    """In name order, without a name last."""
    return [F.col(name).isNull(), F.col(name)]


def _fields(names: str) -> Column:
    return F.struct(*names.split())


def popular_stations(run: Run) -> DataFrame:
    listed = ["station_name", "start_count", "end_count"]
    months = run("station_month_topk").withColumnRenamed("station", "station_name")
    stations = run("station_alltime_topk").withColumnsRenamed({"station": "station_name"})
    months = months.withColumn("rides", F.col("start_count"))
    stations = stations.withColumn("start_count", F.col("rides"))
    order = [_down("start_count"), *_named("station_name")]
    return document(
        {
            "by_month": map_of_lists(months, "ym", order, [*listed, "net", "rides"]),
            "alltime_top30": list_of(stations, order, [*listed, "rides"]),
        }
    )


def bike_type_trends(run: Run) -> DataFrame:
    detail = ["ym", "rideable_type", "member_casual"]
    summary = ["ym", "total_rides", "classic", "electric", "pct_electric"]
    return document(
        {
            "monthly_detail": list_of(
                run("bike_type_monthly"), [F.col(name) for name in detail], [*detail, "rides"]
            ),
            "monthly_summary": list_of(
                run("bike_type_monthly_summary"), [F.col("ym")], summary
            ),
        }
    )


def user_patterns(run: Run) -> DataFrame:
    user = "member_casual"
    overall = _fields("total_rides avg_duration_min median_duration_min")
    return document(
        {
            "overall": map_of(run("user_overall"), user, overall),
            "by_hour": map_of_lists(
                run("user_hourly"), user, [F.col("hour")], ["hour", "rides", "avg_duration_min"]
            ),
            "by_day": map_of_lists(run("user_daily"), user, [F.col("dow")], ["day", "rides"]),
            "by_weekend": map_of_maps(
                run("user_weekend"), user, "is_weekend", _fields("rides avg_duration_min")
            ),
        }
    )


def peak_hours(run: Run) -> DataFrame:
    hours = [F.col("hour")], ["hour", "rides"]
    seasons = run("season_hours")
    return document(
        {
            "by_season": map_of_maps(seasons, "is_weekend", "season", F.col("hours")),
            "simple": map_of_lists(run("peak_hours_simple"), "is_weekend", *hours),
        }
    )


def yoy_growth(run: Run) -> DataFrame:
    return document(
        {
            "monthly": list_of(
                run("yoy_monthly"),
                [F.col("month")],
                ["month", "month_name", "rides_base", "rides_cmp", "change_pct"],
            ),
            "yearly_totals": single(run("yoy_totals"), "rides_base", "rides_cmp", "growth_pct"),
            "by_user_type": map_of_maps(
                run("monthly_rides_by_user"), "ym", "member_casual", F.col("rides")
            ),
        }
    )


def trip_durations(run: Run) -> DataFrame:
    by_bike = ["rideable_type"]
    by_both = ["rideable_type", "member_casual"]
    figures = ["rides", "avg_min", "median_min", "p95_min"]
    points = run("duration_percentiles")

    def listed(name: str, keys: list[str]) -> DataFrame:
        return list_of(run(name), [F.col(key) for key in keys], [*keys, *figures])

    return document(
        {
            "by_bike_type": listed("duration_by_bike", by_bike),
            "by_bike_and_user": listed("duration_by_bike_user", by_both),
            "overall_percentiles_min": single(points, *points.columns),
        }
    )


def top_routes(run: Run) -> DataFrame:
    order = [_down("rides")]
    oneway = run("top_routes_oneway")
    asymmetric = run("asymmetric_routes")
    by_share = [_down("asymmetry_pct"), F.col("station_a"), F.col("station_b")]
    return document(
        {
            "top_oneway": list_of(
                oneway, [*order, F.col("from"), F.col("to")], ["from", "to", "rides"]
            ),
            "top_circular": list_of(
                run("top_routes_circular"), [*order, F.col("station")], ["station", "rides"]
            ),
            "asymmetric_routes": list_of(asymmetric, by_share, asymmetric.columns),
        }
    )


def seasonal_impact(run: Run) -> DataFrame:
    bikes = run("season_electric_share")
    users = run("season_casual_share")
    rides = F.col("rides")
    return document(
        {
            "volume": map_of(run("season_volume"), "season", rides),
            "duration": map_of(
                run("season_duration"), "season", _fields("avg_min median_min p95_min")
            ),
            "bike_mix": map_of_maps(run("season_bike_mix"), "season", "rideable_type", rides),
            "pct_electric": map_of(bikes, "season", F.col("pct_electric")),
            "user_mix": map_of_maps(run("season_user_mix"), "season", "member_casual", rides),
            "pct_casual": map_of(users, "season", F.col("pct_casual")),
            "yoy_by_season": map_of_maps(run("season_by_year"), "year", "season", rides),
        }
    )


def circular_trips(run: Run) -> DataFrame:
    shares = "total_rides circular_rides pct_circular"
    count, rate = run("circular_top_count"), run("circular_top_rate")
    station = F.col("station")
    return document(
        {
            "overall": single(run("circular_overall"), *shares.split()),
            "by_user_type": map_of(run("circular_by_user"), "member_casual", _fields(shares)),
            "duration_comparison": map_of(
                run("circular_duration"), "label", _fields("rides avg_min median_min p95_min")
            ),
            "top_by_count": list_of(
                count, [_down("circular_rides"), station], ["station", "circular_rides"]
            ),
            "top_by_rate": list_of(
                rate, [_down("pct_circular"), *_named("station")], ["station", *shares.split()]
            ),
        }
    )


def recommendations(run: Run) -> DataFrame:
    best = map_of(run("recommend_best"), "hour", _fields("station score starts ends"))
    return document({"by_hour": best})


def recommendations_top5(run: Run) -> DataFrame:
    five = map_of_lists(
        run("recommend_top5"), "hour", [F.col("rank")], ["station", "score", "starts", "ends"]
    )
    return document({"by_hour": five})


DOCUMENTS: dict[str, Callable[[Run], DataFrame]] = {
    build.__name__: build
    for build in (
        popular_stations,
        bike_type_trends,
        user_patterns,
        peak_hours,
        yoy_growth,
        trip_durations,
        top_routes,
        seasonal_impact,
        circular_trips,
        recommendations,
        recommendations_top5,
    )
}


def runner(
    trips: DataFrame,
    cells: Mapping[str, DataFrame] | None = None,
    parameters: Mapping[str, Mapping] | None = None,
) -> Run:
    """Runs a query by name, on the cells that suffice for it; a sketch needs the trips."""

    def run(name: str) -> DataFrame:
        own = (parameters or {}).get(name, {})
        fit = [kind for kind in cells or {} if name in CELLS[kind][1] and not own.get("sketch")]
        return SECTIONS[name](cells[fit[0]] if fit else trips, **own)

    return run


def write_reports(
    spark: SparkSession,
    trips: DataFrame,
    path: str,
    parameters: Mapping[str, Mapping] | None = None,
) -> None:
    """Write all documents below ``path``, replacing earlier ones.

    Each kind of cells is counted in one read of the trips and written there too; all sections
    are read from them. Kinds are counted at the same time, and so are documents written.
    """

    def count_cells(kind: str) -> None:
        CELLS[kind][0](trips).write.mode("overwrite").parquet(f"{path}/{kind}")

    together(spark, [partial(count_cells, kind) for kind in CELLS])
    run = runner(trips, {kind: spark.read.parquet(f"{path}/{kind}") for kind in CELLS}, parameters)
    write_documents(spark, run, path)


def write_documents(spark: SparkSession, run: Run, path: str) -> None:
    """Write every document below ``path``; planning one overlaps with the jobs of others."""

    def write(name: str) -> None:
        write_result(DOCUMENTS[name](run), f"{path}/{name}")

    together(spark, [partial(write, name) for name in DOCUMENTS])
