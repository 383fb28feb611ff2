"""Quantiles that stay distributed.

Spark's quantile aggregates send one sketch or one value map per task to the single task
that owns the group. Here rides are counted first, by (group, whole second): that shuffle
is combined on the map side and spread over all reducers. What follows works on distinct
durations, however many rides share them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from dockflow.functions.figures import MICROS_PER_SECOND
from dockflow.functions.trip import SECONDS_PER_DAY, rides

#: Columns with a handful of values: what has a few rows for each of them may be broadcast.
TYPE_LIKE = frozenset(("rideable_type", "member_casual", "route_kind", "label", "season"))


def per_type(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``frame``, a few rows per value of ``keys``, with a broadcast hint if that has a bound."""
    return F.broadcast(frame) if TYPE_LIKE.issuperset(keys) else frame


def counted(trips: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rides per (keys, value), as ``n``."""
    return trips.groupBy(*keys, value).agg(rides("n"))


def second_profile(
    trips: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float]
) -> DataFrame:
    """rides, total_secs and exact interpolated quantiles of whole-second durations.

    For rides shorter than a day only: a group then has at most 86,399 distinct durations,
    which bounds the value map of ``percentile``.
    """
    seconds = counted(trips, keys, "duration_secs")
    weighted = [
        F.percentile("duration_secs", F.lit(p), F.col("n")).alias(name)
        for name, p in quantiles.items()
    ]
    return seconds.groupBy(*keys).agg(
        F.sum("n").alias("rides"),
        F.sum(F.col("duration_secs") * F.col("n")).alias("total_secs"),
        *weighted,
    )


def ranked_profile(
    trips: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float]
) -> DataFrame:
    """As ``second_profile``, but a quantile is the observed value of rank ceil(p * rides).

    This is what an approximate percentile aims at, with a rank error of 0. The running count
    streams over at most 86,399 sorted durations per group.
    """
    seconds = counted(trips, keys, "duration_secs")
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    upto = group.orderBy("duration_secs").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = seconds.withColumns(
        {"upto": F.sum("n").over(upto), "rides": F.sum("n").over(group)}
    )
    picks = [
        F.min(F.when(F.col("upto") >= F.ceil(F.col("rides") * p), F.col("duration_secs"))).alias(
            name
        )
        for name, p in quantiles.items()
    ]
    return placed.groupBy(*keys).agg(
        F.sum("n").alias("rides"),
        F.sum(F.col("duration_secs") * F.col("n")).alias("total_secs"),
        *picks,
    )


def second_of(value: Column) -> Column:
    return F.floor((value - F.pmod(value, F.lit(MICROS_PER_SECOND))) / MICROS_PER_SECOND)


def by_second(frame: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per (keys, whole second of ``value``): rides, the sums of what they go beyond the second,
    plain and squared, and the extremes.

    The filter holds for every row. It asks for all columns, so whatever else a plan takes
    from this table, it is the same table: counted in one read, shared by all that use it.
    """
    over = F.pmod(F.col("_value"), F.lit(MICROS_PER_SECOND))
    placed = frame.select(*keys, "n", F.col(value).alias("_value")).select(
        *keys, "n", "_value", second_of(F.col("_value")).alias("_second"), over.alias("_rest")
    )
    seconds = placed.groupBy(*keys, "_second").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("_rest") * F.col("n")).alias("_over"),
        F.sum(F.col("_rest").cast("double") * F.col("_rest") * F.col("n")).alias("_squares"),
        F.min("_value").alias("_low"),
        F.max("_value").alias("_high"),
    )
    return seconds.filter("n > 0 AND _over >= 0 AND _squares >= 0 AND _low <= _high")


def wanted_seconds(seconds: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float]) -> DataFrame:
    """The seconds that hold the ranks around each quantile: ``_total`` rides of the group, ``_targets``
    with the offset of each rank (2 i and 2 i + 1 for the i-th quantile) in the second, extremes.

    Ranks are looked up among the days of a group, then among the seconds of the wanted days. Without
    keys, the days of the longest ride are one group.
    """
    day = F.floor(F.col("_second") / SECONDS_PER_DAY)
    seconds = seconds.withColumn("_day", day)
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    days = seconds.groupBy(*keys, "_day").agg(F.sum("n").alias("n"))
    ranks = []
    for i, p in enumerate(quantiles.values()):
        for which, whole in ((2 * i, F.floor), (2 * i + 1, F.ceil)):
            rank = whole(F.lit(p) * (F.col("_total") - 1))
            ranks.append(F.struct(F.lit(which).alias("which"), rank.alias("offset")))
    days = days.withColumn("_total", F.sum("n").over(group)).withColumn("_targets", F.array(*ranks))
    wanted = _holding(days, keys, "_day", group)
    inside = _inside(seconds, wanted, [*keys, "_day"])
    return _holding(inside, [*keys, "_day"], "_second", more=("_low", "_high")).drop("_day")


def wide_quantiles(
    frame: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    seconds: DataFrame | None = None,
) -> DataFrame:
    """Exact interpolated quantiles of any number of distinct values (whole micros) per group.

    A first read counts the rides per second (``seconds``, if the caller has it). A second read keeps
    the rides of the seconds that hold wanted ranks alone. No task holds a
    group: it streams over the days of one group, the 86,400 seconds of a day, or the values
    of one second. Values are shuffled for the wanted seconds only, two per quantile and group.
    """
    seconds = by_second(frame, keys, value) if seconds is None else seconds
    wanted = wanted_seconds(seconds, keys, quantiles)
    placed = frame.select(*keys, "n", F.col(value).alias("_value")).withColumn("_second", second_of(F.col("_value")))
    by = [*keys, "_second"]
    inside = _inside(placed, wanted, by).groupBy(*by, "_total", "_targets", "_value").agg(rides("n"))
    return quantile_values(inside, keys, quantiles)


def quantile_values(inside: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float]) -> DataFrame:
    """The quantiles from the counted values of the wanted seconds."""
    hits = _holding(inside, [*keys, "_second"], "_value").withColumn("_hit", F.explode("_targets"))

    def found(index: int) -> Column:
        return F.max(F.when(F.col("_hit.which") == index, F.col("_value")))

    numbers = range(len(quantiles))
    picked = hits.groupBy(*keys).agg(
        F.max("_total").alias("_total"),
        *[found(2 * i).alias(f"_low_{i}") for i in numbers],
        *[found(2 * i + 1).alias(f"_high_{i}") for i in numbers],
    )
    between = []
    for i, (name, p) in enumerate(quantiles.items()):
        low, high = F.col(f"_low_{i}"), F.col(f"_high_{i}")
        place = F.lit(p) * (F.col("_total") - 1)
        between.append((low + (place - F.floor(place)) * (high - low)).alias(name))
    return picked.select(*keys, *between)


def _holding(
    counts: DataFrame,
    group: Sequence[str],
    step: str,
    window: WindowSpec | None = None,
    more: Sequence[str] = (),
) -> DataFrame:
    """The ``step`` values of each group that hold wanted ranks, with the offsets inside them."""
    upto = (window or Window.partitionBy(*group)).orderBy(step)
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col("_upto") - F.col("n")
    held = F.filter("_targets", lambda t: (t.offset >= before) & (t.offset < F.col("_upto")))
    moved = F.transform(
        held, lambda t: F.struct(t.which.alias("which"), (t.offset - before).alias("offset"))
    )
    kept = counts.withColumn("_upto", F.sum("n").over(upto)).withColumn("_targets", moved)
    return kept.filter(F.size("_targets") > 0).select(*group, step, "_total", "_targets", *more)


def _inside(rows: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of the wanted groups; null-safe, since an unknown type is a group too."""
    there = wanted.select(
        *[F.col(key).alias(f"_t_{key}") for key in keys], "_total", "_targets"
    )
    on = [F.col(key).eqNullSafe(F.col(f"_t_{key}")) for key in keys]
    types = [key for key in keys if not key.startswith("_")]
    return rows.join(per_type(there, types), on).drop(*[f"_t_{key}" for key in keys])
