"""Fixed axes: every hour, weekday or month has a row, also without rides."""

from __future__ import annotations

from pyspark.sql import DataFrame


def on_axis(counts: DataFrame, axis: str, first: int, last: int) -> DataFrame:
    """``counts`` with a row for every ``axis`` value from first to last, 0 where missing."""
    spine = counts.sparkSession.range(first, last + 1, 1, 1).withColumnRenamed("id", axis)
    measures = [name for name in counts.columns if name != axis]
    return spine.join(counts, axis, "left").na.fill(0, measures)
