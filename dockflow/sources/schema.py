"""The monthly trip file."""

from __future__ import annotations

from pyspark.sql import types as T

# Station ids mix numbers and text, and timestamps may be malformed: both are read as text.
TRIP_FILE = T.StructType(
    [
        T.StructField("ride_id", T.StringType()),
        T.StructField("rideable_type", T.StringType()),
        T.StructField("started_at", T.StringType()),
        T.StructField("ended_at", T.StringType()),
        T.StructField("start_station_name", T.StringType()),
        T.StructField("start_station_id", T.StringType()),
        T.StructField("end_station_name", T.StringType()),
        T.StructField("end_station_id", T.StringType()),
        T.StructField("start_lat", T.DoubleType()),
        T.StructField("start_lng", T.DoubleType()),
        T.StructField("end_lat", T.DoubleType()),
        T.StructField("end_lng", T.DoubleType()),
        T.StructField("member_casual", T.StringType()),
    ]
)

#: A file without these columns has no trips.
NEEDED = ("started_at", "ended_at")
