"""Top-k, overall and per group.

The reporting queries cut at a small k. Ties are settled by names, so that a result does
not depend on how the data is partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


MOST_BROADCAST = 100_000


def by_name(*names: str) -> list[Column]:
    return [F.asc_nulls_last(name) for name in names]


def top(frame: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows: every task keeps k candidates, nothing is sorted in full."""
    return frame.orderBy(*order).limit(k)


def few(frame: DataFrame, k: int) -> DataFrame:
    """``frame``, at most k rows, with a broadcast hint unless k is large."""
    return F.broadcast(frame) if k <= MOST_BROADCAST else frame


def top_per_group(
    frame: DataFrame, group: Sequence[str], k: int, *order: Column, rank: str = "rank"
) -> DataFrame:
    """The first k rows of every group, numbered from 1.

    The rank filter is applied before the shuffle as well, so a group sends at most k rows
    per task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return frame.withColumn(rank, F.row_number().over(window).cast("bigint")).filter(
        F.col(rank) <= k
    )
