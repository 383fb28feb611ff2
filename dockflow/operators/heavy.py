"""The busiest groups of very many, without a shuffle of the rows that can't be among them.

Grouping by values that differ in nearly every row (exact positions) combines nothing before the
shuffle. Here rows are first counted by a hash of their group into a fixed number of buckets, which
combines in every task. A bucket's count is an upper bound for each group in it. The groups of the
fullest buckets are counted exactly, and the k-th of these counts is a lower bound for the k-th of
all: only groups in buckets that reach it can be among the first k. What is left is counted exactly,
so the result is that of a full grouping, whatever the data; only when no bucket can be left out,
as when every group has one row, it is a full grouping as well.

Three reads, two of which shuffle the rows of chosen buckets; the first shuffles at most ``buckets``
small rows per task. The broadcast holds at most ``buckets`` numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.trip import rides
from dockflow.operators.ranking import top

BUCKETS = 65_536
#: The fullest buckets that give the lower bound, for every row of the result.
FIRST = 2


def _bucketed(frame: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    # Never NULL, so that the joins add no filter and all reads of the sizes are one exchange.
    return frame.withColumn("bucket", F.xxhash64(*keys).bitwiseAND(F.lit(buckets - 1)))


def _within(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(buckets.select("bucket")), "bucket", "left_semi")


def contenders(frame: DataFrame, keys: Sequence[str], k: int, buckets: int = BUCKETS) -> DataFrame:
    """The rows whose group can be among the ``k`` busiest; every row of a group, or none."""
    if buckets > BUCKETS or buckets & (buckets - 1):
        raise ValueError(f"a power of two, {BUCKETS} at most, as they are broadcast")
    rows = _bucketed(frame, keys, buckets)
    sizes = rows.groupBy("bucket").agg(rides("most"))
    fullest = top(sizes, FIRST * k, F.desc("most"), F.col("bucket"))
    counts = _within(rows, fullest).groupBy(*keys).agg(rides("at_least"))
    # With fewer than k groups there, nothing is known of the k-th.
    first = top(counts, k, F.desc("at_least"))
    least = first.agg(F.when(F.count(F.lit(1)) == k, F.min("at_least"))).scalar()
    return _within(rows, sizes.filter(F.col("most") >= F.coalesce(least, F.lit(0)))).drop("bucket")


def busiest_groups(
    frame: DataFrame, keys: Sequence[str], k: int, *ties: Column, buckets: int = BUCKETS
) -> DataFrame:
    """``keys`` and ``rides`` of the ``k`` groups with most rides, ties settled by ``ties``."""
    counts = contenders(frame, keys, k, buckets).groupBy(*keys).agg(rides())
    return top(counts, k, F.desc("rides"), *ties)
