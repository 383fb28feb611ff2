"""Box-plot statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.figures import MICROS_PER_SECOND
from dockflow.functions.trip import rides
from dockflow.operators.quantiles import (
    _inside,
    by_second,
    per_type,
    quantile_values,
    second_of,
    wanted_seconds,
)

REACH = 1.5
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _bounds(wanted: DataFrame, key: str) -> DataFrame:
    """Per key: the wanted seconds, and from and to which second each fence may lie.

    A quartile lies between the extremes of the seconds that hold its two ranks, so before any
    value is read a fence is known but for a few seconds.
    """
    hits = wanted.withColumn("_hit", F.explode("_targets"))

    def edge(rank: int, column: str, pick) -> Column:
        return pick(F.when(F.col("_hit.which") == rank, F.col(column)))

    q1_low, q1_high = edge(0, "_low", F.min), edge(1, "_high", F.max)
    q3_low, q3_high = edge(4, "_low", F.min), edge(5, "_high", F.max)
    widest = (q3_high - q1_low) * REACH
    least = F.greatest(q3_low - q1_high, F.lit(0)) * REACH

    def second(value: Column) -> Column:
        return F.floor(value / MICROS_PER_SECOND)

    return hits.groupBy(F.col(key).alias("_b_key")).agg(
        F.collect_set("_second").alias("_wanted"),
        (second(q1_low - widest) - 1).alias("_low_from"),
        (second(q1_high - least) + 1).alias("_low_to"),
        (second(q3_low + least) - 1).alias("_high_from"),
        (second(q3_high + widest) + 1).alias("_high_to"),
    )


def box_statistics(frame: DataFrame, key: str, value: Column, unit: int) -> DataFrame:
    """Quartiles, whiskers and number of fliers per key, in units of ``unit``.

    A whisker ends at the outermost value within 1.5 quartile ranges of the box, and never
    inside the box; values beyond it are fliers. One read counts the rides per second, a second
    one the values of the seconds that hold quartiles or may hold a fence; seconds elsewhere lie
    on one side of a fence as a whole, and their extremes are known.
    """
    values = frame.select(key, "n", value.alias("_value"))
    seconds = by_second(values, [key], "_value")
    wanted = wanted_seconds(seconds, [key], QUARTILES)
    bounds = _bounds(wanted, key)

    def beside(rows: DataFrame) -> DataFrame:
        at = F.col("_second")
        near = at.between(F.col("_low_from"), F.col("_low_to"))
        near = near | at.between(F.col("_high_from"), F.col("_high_to"))
        same = F.col(key).eqNullSafe(F.col("_b_key"))
        return rows.join(per_type(bounds, [key]), same).withColumn("_at_fence", near)

    placed = beside(values.withColumn("_second", second_of(F.col("_value"))))
    asked = F.col("_at_fence") | F.array_contains("_wanted", F.col("_second"))
    kept = placed.filter(asked).groupBy(key, "_second", "_value")
    # As in by_second, a filter that asks for all columns lets both uses share the counts.
    kept = kept.agg(rides("n"), F.max("_at_fence").alias("_at_fence")).filter("n > 0 AND (_at_fence OR NOT _at_fence)")
    inside = _inside(kept, wanted.drop("_low", "_high"), [key, "_second"])
    quartiles = quantile_values(inside, [key], QUARTILES).withColumnRenamed(key, "_key")

    whole = beside(seconds).filter(~F.col("_at_fence")).select(key, "n", "_low", "_high")
    single = kept.filter("_at_fence").select(key, "n", F.col("_value").alias("_low"), F.col("_value").alias("_high"))
    both = whole.unionByName(single).join(per_type(quartiles, [key]), F.col(key).eqNullSafe(F.col("_key")))
    fence = REACH * (F.col("q3") - F.col("q1"))
    above, below = F.col("_low") > F.col("q3") + fence, F.col("_high") < F.col("q1") - fence
    boxes = both.groupBy(key, "q1", "median", "q3").agg(
        F.sum("n").alias("rides"),
        F.min(F.when(~below, F.col("_low"))).alias("_low"),
        F.max(F.when(~above, F.col("_high"))).alias("_high"),
        F.sum(F.when(above | below, F.col("n")).otherwise(0)).alias("fliers"),
    )

    def shown(column: Column, name: str) -> Column:
        return F.round(column / unit, 4).alias(name)

    return boxes.select(
        key,
        "rides",
        shown(F.col("q1"), "q1"),
        shown(F.col("median"), "median"),
        shown(F.col("q3"), "q3"),
        shown(F.least("_low", "q1"), "whisker_low"),
        shown(F.greatest("_high", "q3"), "whisker_high"),
        "fliers",
    )
