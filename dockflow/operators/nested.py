"""Small results as nested values: lists in order, maps by key.

For results whose size is bounded by a top-k or by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_NAME = "null"


def ordered_list(order: Sequence[Column], value: Column) -> Column:
    """Aggregate: the values as a list in ascending order of ``order``."""
    sortable = [column.alias(f"o{i}") for i, column in enumerate(order)]
    entries = F.array_sort(
        F.collect_list(F.struct(F.struct(*sortable).alias("o"), value.alias("v"))),
        lambda a, b: F.when(a.o < b.o, -1).when(a.o > b.o, 1).otherwise(0),
    )
    return F.transform(entries, lambda entry: entry.v)


def keyed(key: Column, value: Column) -> Column:
    """Aggregate: a map in key order; a missing key becomes the text ``null``."""
    entry = F.struct(F.coalesce(key.cast("string"), F.lit(NO_NAME)).alias("k"), value.alias("v"))
    entries = F.array_sort(
        F.collect_list(entry),
        lambda a, b: F.when(a.k < b.k, -1).when(a.k > b.k, 1).otherwise(0),
    )
    return F.map_from_entries(entries)


def list_of(rows: DataFrame, order: Sequence[Column], fields: Sequence[str | Column]) -> DataFrame:
    """One row with all rows as a list of objects."""
    return rows.agg(ordered_list(order, F.struct(*fields)).alias("value"))


def map_of(rows: DataFrame, key: str, value: Column) -> DataFrame:
    """One row with a map from key to value."""
    return rows.agg(keyed(F.col(key), value).alias("value"))


def map_of_maps(rows: DataFrame, outer: str, inner: str, value: Column) -> DataFrame:
    """One row with a map of maps."""
    grouped = rows.groupBy(outer).agg(keyed(F.col(inner), value).alias("value"))
    return map_of(grouped, outer, F.col("value"))


def map_of_lists(
    rows: DataFrame, key: str, order: Sequence[Column], fields: Sequence[str | Column]
) -> DataFrame:
    """One row with a map from key to a list of objects."""
    grouped = rows.groupBy(key).agg(ordered_list(order, F.struct(*fields)).alias("value"))
    return map_of(grouped, key, F.col("value"))


def single(rows: DataFrame, *fields: str) -> DataFrame:
    """The only row as one object."""
    return rows.select(F.struct(*fields).alias("value"))


def document(sections: dict[str, DataFrame]) -> DataFrame:
    """One row with a column per section."""
    spark = next(iter(sections.values())).sparkSession
    columns = [section.scalar().alias(name) for name, section in sections.items()]
    return spark.range(1).select(*columns)
