"""Departures and arrivals per station."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def station_flows(
    trips: DataFrame,
    start_keys: Mapping[str, Column] | None = None,
    end_keys: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per (keys, station) with ``starts`` and ``ends``; absent sides are 0.

    Every trip counts once for the station it leaves, under ``start_keys``, and once for the
    station it reaches, under ``end_keys``. Both counts come out of one scan and one shuffle
    of map-side combined rows; a full outer join of two counts would take two scans and three
    shuffles. Grouping is null-safe, so unnamed stations meet in one row.

    Flow cells, which are halves of trips already, take the keys of their side.
    """
    start_keys = dict(start_keys or {})
    end_keys = dict(end_keys or start_keys)
    n, none = F.col("n"), F.lit(0).cast("bigint")
    if "is_start" in trips.columns:
        leaves = F.col("is_start")
        keys = [F.when(leaves, key).otherwise(end_keys[name]).alias(name) for name, key in start_keys.items()]
        return trips.groupBy(*keys, "station").agg(
            F.sum(F.when(leaves, n).otherwise(none)).alias("starts"),
            F.sum(F.when(leaves, none).otherwise(n)).alias("ends"),
        )

    def event(keys: Mapping[str, Column], station: str, starts: Column, ends: Column) -> Column:
        return F.struct(
            *[key.alias(name) for name, key in keys.items()],
            F.col(station).alias("station"),
            starts.alias("starts"),
            ends.alias("ends"),
        )

    events = trips.select(
        F.inline(
            F.array(
                event(start_keys, "start_station_name", n, none),
                event(end_keys, "end_station_name", none, n),
            )
        )
    )
    return events.groupBy(*start_keys, "station").agg(
        F.sum("starts").alias("starts"), F.sum("ends").alias("ends")
    )
