"""What the plans may and may not contain, what the totals must add up to, and sketches."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import PARAMETERS, entry, trips
from bench import scans
from dockflow.functions.trip import bounded, bounded_named, started, valid
from dockflow.plans import bikes, circular, durations, recommend, routes, stations
from dockflow.plans.catalog import QUERIES
from dockflow.sources.table import read_trips, write_trips
from dockflow.sources.warehouse import raw_trips


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("trips"))
    write_trips(raw_trips(spark, small), path)
    return read_trips(spark, path)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# Queries that look at the trips before they count them.
TWO_READS = {
    "station_end_heavy_latest",
    "bike_type_latest_month",
    "duration_histogram",
    "long_ride_histogram",
}
# Queries that use their counts more than once, and how often they read the trips when the
# exchange below the counts is reused while running.
SHARED_COUNTS = {
    "hourly_rides_per_day": 1,
    "duration_describe": 2,
    "long_ride_describe": 2,
    "duration_box_by_bike": 2,
    "circular_box": 2,
    "overview_duration": 2,
    "station_map_points": 2,
    "duration_sketch_by_bike": 2,
    "duration_sketch_by_bike_user": 2,
    "duration_sketch_rollup": 2,
    "top_routes_geo": 3,
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(stored, name):
    text = plan(QUERIES[name](stored, **PARAMETERS.get(name, {})))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in text
    if name not in SHARED_COUNTS:
        assert text.count("FileScan parquet") == (2 if name in TWO_READS else 1)


@pytest.mark.parametrize("name", sorted(SHARED_COUNTS))
def test_counts_are_shared(stored, name):
    frame = QUERIES[name](stored, **PARAMETERS.get(name, {}))
    frame.collect()
    assert scans(frame) == SHARED_COUNTS[name]


def test_latest_month_reads_one_partition(spark, stored):
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        text = plan(stations.station_end_heavy_latest(stored))
        names_only = plan(bikes.bike_type_latest_month(stored))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)
    for shown in (text, names_only):
        filters = shown.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
        assert "year#" in filters and "Subquery" in filters
    assert "ReadSchema: struct<>" in names_only


def shown(spark, frame):
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        return plan(frame)
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)


@pytest.mark.parametrize("name", ["bike_type_at_periods", "yoy_same_month", "monthly_volume_by_file"])
def test_period_prunes_partitions(spark, stored, name):
    text = shown(spark, QUERIES[name](stored, **PARAMETERS.get(name, {})))
    assert "file_period#" in text.split("PartitionFilters: [")[1].split("], PushedFilters")[0]


def test_map_points_read_no_ids_and_few_partitions(spark, stored):
    text = shown(spark, stations.station_map_points(stored))
    assert ":ride_id" not in text and "ride_id:" not in text.replace("has_ride_id:", "")
    assert "dynamicpruning" in text


def test_no_row_is_multiplied_for_distinct_counts(stored):
    assert "Expand" not in plan(QUERIES["overview_counts"](stored))


@pytest.mark.parametrize("name", ["duration_describe", "long_ride_describe", "overview_duration", "duration_box_by_bike", "circular_box"])
def test_values_are_shuffled_for_wanted_seconds_only(stored, name):
    """What is exchanged by value has been joined with the wanted seconds before."""
    text = plan(QUERIES[name](stored, **PARAMETERS.get(name, {})))
    for part in text.split("Exchange hashpartitioning(")[1:]:
        keys = part.split(", 8)")[0]
        assert "_value#" not in keys or "_second#" in keys
        assert "duration_us#" not in keys
    if name in ("duration_box_by_bike", "circular_box"):
        assert "SinglePartition" not in text


def test_stored_durations_are_pushed_down(spark, stored):
    text = shown(spark, QUERIES["season_volume"](stored))
    assert "GreaterThanOrEqual(duration_secs,1)" in text


def test_view_shuffles_the_large_table_on_its_order_key(spark, small):
    text = plan(QUERIES["monthly_rides"](trips(spark, small)))
    assert text.count("Exchange hashpartitioning(l_orderkey") <= 1
    assert "l_extendedprice" not in text


def test_entry(spark):
    assert entry(spark).count() == 12


def total(frame, column):
    return frame.agg(F.sum(column)).first()[0]


def test_totals(stored):
    assert total(stations.station_starts_monthly(stored), "start_count") == bounded(stored).count()
    assert total(stations.station_ends_monthly(stored), "end_count") == bounded(stored).count()
    inflow = recommend.station_net_inflow(stored, min_activity=0)
    assert total(inflow, "starts") == total(inflow, "ends") == bounded_named(stored).count()
    assert total(routes.route_counts(stored), "rides") == started(stored).count()
    assert total(bikes.bike_type_monthly(stored), "rides") == started(stored).count()
    assert total(circular.circular_duration(stored), "rides") == valid(stored).count()
    assert total(circular.circular_split(stored), "pct") == pytest.approx(100, abs=0.2)


@pytest.mark.parametrize("query", [durations.duration_by_bike, durations.duration_percentiles])
def test_sketch_is_within_its_rank_error(stored, query):
    """The rank of the sketched value is off by at most 1/10000 of the rides."""
    rows = valid(stored)
    sketched = [r.asDict() for r in query(stored, sketch=True).collect()]
    for row in sketched:
        group = rows
        if "rideable_type" in row:
            group = rows.filter(F.col("rideable_type") == row["rideable_type"])
        values = sorted(r.duration_secs for r in group.select("duration_secs").collect())
        slack = len(values) / 10000 + 1
        points = {"median_min": 0.5, "p95_min": 0.95, **durations.SPREAD}
        for name, p in points.items():
            if name in row:
                rank = p * len(values)
                low = values[max(0, int(rank - slack) - 1)]
                high = values[min(len(values) - 1, int(rank + slack) + 1)]
                assert low / 60 - 0.05 <= row[name] <= high / 60 + 0.05
