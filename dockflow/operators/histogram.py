"""Equal-width histograms over exact integer micros.

The bin of a value is computed with integer division, and the last bin includes its upper
edge. Every bin is listed, 0 where it holds no ride; each row carries its own edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.trip import rides


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    # In decimals: a ride that ends in 9999 times the number of bins is beyond BIGINT.
    scaled = (value - low).cast("decimal(20,0)") * F.lit(bins).cast("decimal(6,0)")
    width = (high - low).cast("decimal(20,0)")
    return F.least(((scaled - scaled % width) / width).cast("bigint"), F.lit(bins - 1)) + 1


def fixed_histogram(
    frame: DataFrame,
    value: Column,
    bins: int,
    low: int,
    high: int,
    unit: int,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Rides per bin of ``low..high``, for every label that occurs; values outside are not counted."""
    values = frame.select(*keys, "n", value.alias("_value"))
    edges = [F.lit(low), F.lit(high)]
    inside = F.when(F.col("_value").between(low, high), _bin(F.col("_value"), *edges, bins))
    counts = values.groupBy(*keys, inside.alias("bin")).agg(rides())
    return _every_bin(counts, keys, bins).select(*keys, "bin", *_edges(*edges, bins, unit), "rides")


def range_histogram(frame: DataFrame, value: Column, bins: int, unit: int) -> DataFrame:
    """Rides per bin of the observed range; a single value sits in a range of one unit.

    The range is a scalar subquery over the same single column, then the bins are counted:
    two pruned scans, and no more than ``bins`` rows per task in the only large shuffle.
    """
    values = frame.select("n", value.alias("_value"))
    low, high = F.min("_value"), F.max("_value")
    pad = F.when(low == high, unit // 2).otherwise(0)
    span = values.agg(F.struct((low - pad).alias("low"), (high + pad).alias("high"))).scalar()
    counts = (
        values.withColumn("_span", span)
        .groupBy(
            F.col("_span"),
            _bin(F.col("_value"), F.col("_span.low"), F.col("_span.high"), bins).alias("bin"),
        )
        .agg(rides())
    )
    edges = [F.col("_span.low"), F.col("_span.high")]
    return _every_bin(counts, ["_span"], bins).select("bin", *_edges(*edges, bins, unit), "rides")


def _every_bin(counts: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    """``bins`` rows per key, from at most one row (keys, bin, rides) for each."""
    held = F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "rides")))
    axis = F.sequence(F.lit(1).cast("bigint"), F.lit(bins).cast("bigint"))
    listed = counts.groupBy(*keys).agg(F.map_from_entries(held).alias("_held"))
    return listed.select(*keys, "_held", F.explode(axis).alias("bin")).withColumn(
        "rides", F.coalesce(F.try_element_at("_held", F.col("bin")), F.lit(0))
    )


def _edges(low: Column, high: Column, bins: int, unit: int) -> list[Column]:
    def edge(index: Column) -> Column:
        big = [x.cast("decimal(20,0)") for x in (low, high)]
        return (big[0] * bins + index * (big[1] - big[0])).cast("double") / (bins * unit)

    return [edge(F.col("bin") - 1).alias("low"), edge(F.col("bin")).alias("high")]
