"""Trips seen through an order warehouse: the raw-trip view over the test tables.

A line item is a ride, the supplier's nation its start station, the customer's nation its
end station. Integer arithmetic only, so that any SQL engine builds the same rows.

Plan: orders meet customers and line items meet suppliers *before* the two meet on the
order key, so the large table is shuffled at most twice (left-deep it would be three
times). No side carries a broadcast hint: every dimension is joined as a plain scan, whose
size the optimizer knows. It broadcasts the small ones (the nation table always is) and
sorts and merges otherwise, where adaptive execution splits a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions.clock import seconds_since


def _nations(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    return nation.select(
        F.col("n_nationkey").alias(f"{prefix}_key"),
        F.col("n_nationkey").cast("bigint").alias(f"{prefix}_station_id"),
        F.col("n_name").alias(f"{prefix}_station"),
    )


def _every(n: int) -> Column:
    return F.col("l_partkey") % n == 0


def raw_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Raw trips: the columns of a trip file, ``file_name`` and ``file_period``."""
    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    supplier = spark.read.parquet(f"{folder}/supplier.parquet")
    customer = spark.read.parquet(f"{folder}/customer.parquet")

    arrivals = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        _nations(spark, folder, "end"), F.col("c_nationkey") == F.col("end_key")
    )
    departures = lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        _nations(spark, folder, "start"), F.col("s_nationkey") == F.col("start_key")
    )
    joined = departures.join(arrivals, F.col("l_orderkey") == F.col("o_orderkey"))

    quantity = F.col("l_quantity").cast("bigint")
    same = F.col("start_station_id") == F.col("end_station_id")
    offset = (
        F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey") * 31
    ) % 86400
    length = (
        F.when(_every(89), F.lit(0))
        .when(_every(83), -quantity)
        .when(_every(79), 86400 + quantity)
        .otherwise(quantity * 47 + F.col("l_orderkey") % 600 + F.when(same, 600).otherwise(0))
    )
    midnight = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    second = F.expr("INTERVAL '1' SECOND")
    ordered = seconds_since("1970-01-01", F.col("o_orderdate"))
    timed = joined.withColumn("start_s", ordered + offset)

    def text(seconds: Column) -> Column:
        return (midnight + second * seconds).cast("string")

    period = F.date_format("o_orderdate", "yyyyMM")
    part = F.col("l_linenumber") % 7
    file_name = (
        F.when(part == 0, F.concat(F.lit("JC-"), period, F.lit("-trips.csv")))
        .when(part == 1, F.concat(period, F.lit("-trips.txt")))
        .when(part == 2, F.lit("trips.csv"))
        .when(part == 3, F.concat(period, F.lit("-trips_2.csv")))
        .otherwise(F.concat(period, F.lit("-trips.csv")))
    )

    return timed.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("ride_id"),
        F.when(F.col("l_linestatus") == "O", "electric_bike")
        .otherwise("classic_bike")
        .alias("rideable_type"),
        F.when(_every(97), "n/a").otherwise(text(F.col("start_s"))).alias("started_at"),
        F.when(_every(101), "n/a").otherwise(text(F.col("start_s") + length)).alias("ended_at"),
        F.when(~_every(103), F.col("start_station")).alias("start_station_name"),
        F.col("start_station_id").cast("string").alias("start_station_id"),
        F.when(~_every(107), F.col("end_station")).alias("end_station_name"),
        F.col("end_station_id").cast("string").alias("end_station_id"),
        F.expr("CAST(40.0 + start_station_id * 0.01 AS DOUBLE)").alias("start_lat"),
        F.expr("CAST(-74.0 + start_station_id * 0.01 AS DOUBLE)").alias("start_lng"),
        F.expr("CAST(40.0 + end_station_id * 0.01 AS DOUBLE)").alias("end_lat"),
        F.expr("CAST(-74.0 + end_station_id * 0.01 AS DOUBLE)").alias("end_lng"),
        F.when(F.col("l_returnflag") == "R", "casual").otherwise("member").alias("member_casual"),
        file_name.alias("file_name"),
        period.alias("file_period"),
    )
