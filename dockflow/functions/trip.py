"""The trip record: types, derived columns, populations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions import clock

CLASSIC = "classic_bike"
ELECTRIC = "electric_bike"
MEMBER = "member"
CASUAL = "casual"

CIRCULAR = "circular"
ONE_WAY = "one_way"
UNKNOWN = "unknown"

SECONDS_PER_DAY = 86400


def typed(raw: DataFrame) -> DataFrame:
    """Raw trips (timestamps as text) to typed trips. Keeps every row."""
    start = clock.parse_wall_clock(F.col("started_at"))
    end = clock.parse_wall_clock(F.col("ended_at"))
    parsed = raw.withColumns({"started_at": start, "ended_at": end})
    return parsed.withColumns(
        {
            "duration_secs": clock.elapsed_seconds(F.col("started_at"), F.col("ended_at")),
            "duration_us": clock.elapsed_micros(F.col("started_at"), F.col("ended_at")),
        }
    )


def _in_range(value: Column, low: int, beyond: int) -> Column:
    """low <= value < beyond, mentioning the value once: for raw trips.

    A pair of comparisons would, as a pushed-down filter over raw trips, parse both
    timestamps twice for every row. On a stored table it is what Parquet statistics can use.
    """
    return F.width_bucket(value, F.lit(low), F.lit(beyond), F.lit(1)) == 1


def with_labels(frame: DataFrame) -> DataFrame:
    """Add what follows from ``year``, ``month``, ``dow`` and ``is_circular``.

    ``month_no`` and ``season`` depend on the partition columns of a stored table alone, so
    that filters on them prune partitions.
    """
    same = F.col("is_circular")
    return frame.withColumns(
        {
            "month_no": F.col("year") * 100 + F.col("month"),
            "season": clock.season(F.col("month")),
            "day_class": clock.day_class(F.col("dow")),
            "route_kind": F.when(same, CIRCULAR).when(~same, ONE_WAY).otherwise(UNKNOWN),
        }
    )


def with_numbers(trips: DataFrame) -> DataFrame:
    """Add the calendar numbers of the start, the hour of the end, and whether there is a ride id.

    Each number is NULL exactly where its timestamp is. The flag spares counts of ids the ids.
    """
    return trips.withColumns(
        {
            "has_ride_id": F.col("ride_id").isNotNull(),
            "year": F.year("started_at"),
            "month": F.month("started_at"),
            "dow": clock.iso_weekday(F.col("started_at")),
            "hour": F.hour("started_at"),
            "end_hour": F.hour("ended_at"),
        }
    )


def with_calendar(trips: DataFrame) -> DataFrame:
    """Add the calendar and route columns. Unused ones are pruned by the optimizer.

    A stored table has the numbers: there, a query by month or hour reads no timestamps.
    """
    seconds = F.col("duration_secs")
    in_a_day = seconds.between(1, SECONDS_PER_DAY - 1)
    if "end_hour" not in trips.columns:
        trips = with_numbers(trips)
        in_a_day = _in_range(seconds, 1, SECONDS_PER_DAY)
    has_start, has_end = F.col("year").isNotNull(), F.col("end_hour").isNotNull()
    derived = trips.withColumns(
        {
            "is_circular": F.col("start_station_name") == F.col("end_station_name"),
            "is_started": has_start,
            "is_bounded": has_start & has_end,
            "is_named": F.col("start_station_name").isNotNull() & F.col("end_station_name").isNotNull(),
            "is_valid": in_a_day,
            "is_positive": F.col("duration_us") > 0,
            "n": F.lit(1).cast("bigint"),
            "total_secs": seconds,
            "total_us": F.col("duration_us"),
        }
    )
    return with_labels(derived)


def prepare(raw: DataFrame) -> DataFrame:
    """Raw trips to the frame every query takes."""
    return with_calendar(typed(raw))


# The populations. Which one a query counts is part of its definition.


def started(trips: DataFrame) -> DataFrame:
    return trips.filter("is_started")


def bounded(trips: DataFrame) -> DataFrame:
    return trips.filter("is_bounded")


def bounded_named(trips: DataFrame) -> DataFrame:
    return bounded(trips).filter("is_named")


def valid(trips: DataFrame) -> DataFrame:
    """Longer than nothing and shorter than a day, in whole seconds."""
    return trips.filter("is_valid")


def positive(trips: DataFrame) -> DataFrame:
    """Any ride that took time, fractions of a second included, without an upper bound."""
    return trips.filter("is_positive")


def rides(name: str = "rides") -> Column:
    """Number of rides: every row stands for ``n`` of them, which is 1 in a trip table."""
    return F.coalesce(F.sum("n"), F.lit(0)).alias(name)


def count_where(condition: Column, name: str) -> Column:
    """Rides for which the condition is true; NULL counts as not true."""
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias(name)
