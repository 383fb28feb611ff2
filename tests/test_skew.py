"""Trips of which a third share one route, hour and duration, with fractional seconds."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import PARAMETERS
from dockflow.functions.trip import prepare
from dockflow.plans.catalog import QUERIES
from dockflow.sources.warehouse import raw_trips
from oracle.queries import SQL
from oracle.trips import RAW
from tests.compare import duck_rows, oracle, same, spark_rows

# ``started_text`` and ``ended_text`` are what the SQL calls the raw timestamps.
NAMED = {"started_at": "started_text", "ended_at": "ended_text"}


@pytest.fixture(scope="module")
def skewed(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skewed"))
    view = raw_trips(spark, small)
    digits = F.pmod(F.hash("ride_id", "started_at"), F.lit(1000000))
    fraction = F.format_string(".%06d", digits)
    readable = F.col("ended_at") != "n/a"
    spread = view.withColumn(
        "ended_at", F.when(readable, F.concat("ended_at", fraction)).otherwise(F.col("ended_at"))
    )
    moved = (F.pmod(F.hash("ride_id"), F.lit(7)) - 3) * F.lit(0.001)
    spread = spread.withColumns(
        {
            "start_lat": F.when(F.pmod(F.hash("ride_id"), F.lit(11)) > 0, F.col("start_lat") + moved),
            "ride_id": F.when(F.pmod(F.hash("ride_id"), F.lit(13)) > 0, F.col("ride_id")),
        }
    )
    hot = spread.filter("start_station_name = end_station_name and ended_at != 'n/a'")
    copies = hot.orderBy("ride_id", "started_at", "start_lat").limit(1).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.lit(30000)))
    )
    spread.unionByName(copies.drop("copy")).repartition(5).write.mode("overwrite").parquet(path)
    return path


@pytest.fixture(scope="module")
def duck(skewed, small):
    connection = oracle(small)
    connection.execute(f"CREATE VIEW skewed AS SELECT * FROM read_parquet('{skewed}/*.parquet')")
    return connection


NAMES = [
    "station_month_topk",
    "station_map_points",
    "user_overall",
    "hourly_rides_per_day",
    "duration_by_bike",
    "duration_by_bike_exact",
    "duration_sketch_by_bike",
    "duration_sketch_by_bike_user",
    "duration_sketch_rollup",
    "duration_describe",
    "duration_histogram",
    "duration_box_by_bike",
    "long_ride_describe",
    "long_ride_histogram",
    "asymmetric_routes",
    "top_routes_geo",
    "season_duration",
    "circular_duration",
    "circular_top_rate",
    "circular_histogram",
    "circular_box",
    "recommend_top5",
    "overview_duration",
    "overview_counts",
    "load_profile",
    "file_load_plan",
]


def close(left, right) -> bool:
    """Fractions end on rounding ties nowhere, but quantiles may differ in the last bit."""
    if isinstance(left, float) and isinstance(right, float):
        return left == pytest.approx(right, rel=1e-9, abs=1e-6)
    return same(left, right)


@pytest.mark.parametrize("name", NAMES)
def test_matches(spark, skewed, duck, name):
    trips = prepare(spark.read.parquet(skewed))
    columns, found = spark_rows(QUERIES[name](trips, **PARAMETERS.get(name, {})))
    renamed = ", ".join(f"{old} AS {new}" for old, new in NAMED.items())
    raw = f"WITH raw AS (SELECT * EXCLUDE (started_at, ended_at), {renamed} FROM skewed)"
    expected_columns, expected = duck_rows(duck, SQL[name].replace(RAW, raw))
    assert columns == expected_columns
    assert len(found) == len(expected) > 0
    for left, right in zip(found, expected, strict=True):
        assert all(map(close, left, right)), (left, right)


def test_hot_order_is_split_in_the_view(spark, small, tmp_path_factory):
    """A third of the line items in one order, joined without any broadcast."""
    folder = str(tmp_path_factory.mktemp("warehouse"))
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    order, supplier = lines.select("l_orderkey", "l_suppkey").first()
    hot = lines.limit(30000).withColumns(
        {"l_orderkey": F.lit(order), "l_suppkey": F.lit(supplier)}
    )
    lines.unionByName(hot).repartition(16).write.parquet(f"{folder}/lineitem.parquet")
    for table in ("orders", "supplier", "customer", "nation"):
        spark.read.parquet(f"{small}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
    # What a cluster sees with large tables, scaled down.
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        frame = QUERIES["route_counts"](prepare(raw_trips(spark, folder)))
        found = spark_rows(frame)
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in plan
    connection = oracle(folder, glob="/*.parquet")
    assert found == duck_rows(connection, SQL["route_counts"])
