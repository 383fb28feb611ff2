"""The whole data set at a glance, and what is wrong with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.figures import MICROS_PER_MINUTE
from dockflow.functions.trip import SECONDS_PER_DAY, count_where, positive, rides
from dockflow.operators.quantiles import by_second, wide_quantiles
from dockflow.operators.shares import long_counts, share_of
from dockflow.plans.durations import mean_of
from dockflow.sources.files import LONG, SHORT, period_of, row_fault, wanted_name, with_status
from dockflow.sources.schema import TRIP_FILE


def overview_counts(trips: DataFrame) -> DataFrame:
    """Rides, stations in use and the first and last start.

    Rides are combined to station pairs first; each pair then names its two stations.
    """
    pairs = (
        positive(trips)
        .groupBy("start_station_name", "end_station_name")
        .agg(rides("n"), F.min("started_at").alias("first"), F.max("started_at").alias("last"))
    )

    def station(name: str, is_start: bool) -> Column:
        n = F.col("n") if is_start else F.lit(0).cast("bigint")
        return F.struct(F.col(name).alias("station"), F.lit(is_start).alias("is_start"), n.alias("n"), "first", "last")

    ends = [station("start_station_name", True), station("end_station_name", False)]
    stations = (
        pairs.select(F.inline(F.array(*ends)))
        .groupBy("station", "is_start")
        .agg(rides("n"), F.min("first").alias("first"), F.max("last").alias("last"))
    )
    named = F.col("station").isNotNull()
    return stations.agg(
        rides("total_rides"),
        F.count_if(named & F.col("is_start")).alias("start_stations"),
        F.count_if(named & ~F.col("is_start")).alias("end_stations"),
        F.min("first").alias("first_start"),
        F.max("last").alias("last_start"),
    )


def overview_mix(trips: DataFrame) -> DataFrame:
    """Rides and their share by user type and by bike type, as long rows."""
    dimensions = {"user": "member_casual", "bike": "rideable_type"}
    counts = long_counts(positive(trips), dimensions).filter(F.col("value").isNotNull())
    return counts.withColumn("pct", share_of("rides", ["dimension"]))


def overview_duration(trips: DataFrame) -> DataFrame:
    """Mean and median minutes."""
    rows = positive(trips)
    seconds = by_second(rows, [], "duration_us")
    median = wide_quantiles(rows, [], "duration_us", {"median": 0.5}, seconds)
    return seconds.agg(F.round(mean_of(MICROS_PER_MINUTE), 1).alias("avg_min")).select(
        "avg_min",
        F.round(median.select("median").scalar() / MICROS_PER_MINUTE, 1).alias("median_min"),
    )


def load_profile(trips: DataFrame) -> DataFrame:
    """Rows loaded and rows that some query will leave out, in one pass."""
    seconds = F.col("duration_secs")
    return trips.agg(
        rides("rows_loaded"),
        count_where(~F.col("is_started"), "bad_start"),
        count_where(F.col("end_hour").isNull(), "bad_end"),
        count_where((seconds <= 0) | (seconds >= SECONDS_PER_DAY), "bad_duration"),
        count_where(F.col("start_station_name").isNull(), "no_start_station"),
        count_where(F.col("end_station_name").isNull(), "no_end_station"),
    )


def file_selection(trips: DataFrame) -> DataFrame:
    """Every file that rows came in: part of the data set or not, its period, its rows."""
    counts = trips.groupBy("file_name").agg(rides())
    name = F.col("file_name")
    return counts.select(name, wanted_name(name).alias("wanted"), period_of(name).alias("period"), "rides")


def file_load_plan(trips: DataFrame, known: Sequence[str] = ()) -> DataFrame:
    """What a load would do with the wanted files of the rows, a folder per bike type, if the files
    in ``known`` were loaded before."""
    name = F.col("file_name")
    path = F.concat_ws("/", "rideable_type", "file_name").alias("path")
    listed = trips.filter(wanted_name(name)).groupBy("file_name", path).agg(rides())
    return with_status(listed, name.isin(*known))


def file_row_faults(trips: DataFrame, every_short: int = 61, every_long: int = 67) -> DataFrame:
    """Rows of each file that a load would take or reject, if the trips were written as lines of trip
    files and every so many of them lost its last field or got one more."""

    def quoted(name: str) -> Column:
        return F.concat(F.lit('"'), F.replace(F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))

    ride = F.col("ride_id").try_cast("bigint")
    *most, last = [quoted(name) for name in TRIP_FILE.names]
    rest = F.when(ride % every_short == 0, F.array(F.lit(None).cast("string"))).when(ride % every_long == 0, F.array(last, F.lit("more,"))).otherwise(F.array(last))
    line = F.concat_ws(",", *most, rest)
    faults = trips.select("file_name", "n", row_fault(line, len(TRIP_FILE.names)).alias("fault"))
    return faults.groupBy("file_name").agg(
        rides("rows"),
        count_where(F.col("fault") == SHORT, "short"),
        count_where(F.col("fault") == LONG, "long"),
    )
