"""Monthly trip files: CSV with a header, named by period.

A file's columns are found by the names in its own header, in any order: unknown columns are left
out, absent ones are NULL. A file whose header lacks a start or an end time is refused as a whole.
A row with more or fewer fields than its file's header is no trip, but a rejected row with a fault.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockflow.sources.claims import first_line
from dockflow.sources.schema import NEEDED, TRIP_FILE

# Which files belong to the data set. Files and folders whose name begins
# with "." or "_" (left behind by archive tools) are never listed by Spark.
WANTED = "*.csv"
OTHER_SYSTEM = "JC-"

LISTING = {"pathGlobFilter": WANTED, "recursiveFileLookup": "true"}
BAD_ROW = "_bad_row"
#: What is wrong with a rejected row, or with the header of a refused file.
SHORT, LONG, UNREADABLE, HEADER = "short", "long", "unreadable", "header"


def wanted_name(name: Column) -> Column:
    """Whether a file of this name is part of the data set."""
    hidden = name.startswith(".") | name.startswith("_")
    return name.endswith(WANTED.removeprefix("*")) & ~name.startswith(OTHER_SYSTEM) & ~hidden


def period_of(name: Column) -> Column:
    """The period (YYYYMM) a file's name begins with; NULL without one."""
    return F.nullif(F.regexp_extract(name, r"^(\d{6})", 1), F.lit(""))


def file_columns() -> list[Column]:
    """The file a row came in, and the period in the file's name."""
    name = F.col("_metadata.file_name")
    return [name.alias("file_name"), period_of(name).alias("file_period")]


def with_status(listed: DataFrame, known: Column) -> DataFrame:
    """Files (file_name, path, …) with their ``status`` in a load: ``skipped`` if the name is known
    already, ``new``, or ``repeated`` if another new file of the name has an earlier path."""
    first = F.min("path").over(Window.partitionBy("file_name"))
    new = F.when(F.col("path") == first, "new").otherwise("repeated")
    return listed.withColumn("status", F.when(known, "skipped").otherwise(new))


def row_fault(row: Column, fields: int) -> Column:
    """What is wrong with a row that has not ``fields`` fields; commas in quotes divide no fields."""
    plain = F.regexp_replace(row, '"([^"]|"")*"', "")
    found = F.length(plain) - F.length(F.replace(plain, F.lit(","))) + 1
    return F.when(found < fields, SHORT).when(found > fields, LONG).otherwise(UNREADABLE)


def header_columns(line: str | None) -> tuple[str, ...]:
    """Names for the columns of a header: a known one once, anything else by its place."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([line.removeprefix("﻿")]), []) if line else []):
        name = name.strip().lower()
        names.append(name if name in TRIP_FILE.names and name not in names else f"_column_{i}")
    return tuple(names)


def _by_header(spark: SparkSession, paths: Iterable[str]) -> dict[tuple[str, ...], list[str]]:
    """Files with the same columns; one line of each file is read, by the driver."""
    groups = defaultdict(list)
    for path in paths:
        groups[header_columns(first_line(spark, path))].append(path)
    return groups


def _parsed(spark: SparkSession, names: tuple[str, ...], paths: list[str], checked: bool) -> DataFrame:
    """The trip columns of files with one header; with ``checked`` also ``_bad_row``, the text of a row
    with another number of fields."""
    kept = [BAD_ROW] if checked else []
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, *kept]])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        # All files have this header, so the places of the columns are known.
        .option("enforceSchema", True)
        .option("columnNameOfCorruptRecord", BAD_ROW)
        .option("columnPruning", not checked)
        .csv(paths)
    )
    found = [
        (F.col(field.name) if field.name in names else F.lit(None)).try_cast(field.dataType).alias(field.name)
        for field in TRIP_FILE
    ]
    if not checked:
        return rows.select(*found, *file_columns())
    # Spark refuses to read the text of bad rows alone, so it is never asked for without a column.
    text = F.concat(BAD_ROW, F.substring(F.coalesce(F.col(names[0]), F.lit("")), 1, 0))
    fault = F.when(text.isNotNull(), row_fault(text, len(names)))
    return rows.select(*found, *file_columns(), text.alias(BAD_ROW), fault.alias("_fault"))


def _nothing(spark: SparkSession, more: str = "") -> DataFrame:
    columns = [f"{field.name} {field.dataType.simpleString()}" for field in TRIP_FILE]
    return spark.createDataFrame([], ", ".join([*columns, "file_name string", "file_period string"]) + more)


def checked_rows(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """All rows of the files with ``_bad_row`` and ``_fault``, both NULL for a trip. A refused file is
    one row, its header; a file without a line has none."""
    out = _nothing(spark, f", {BAD_ROW} string, _fault string")
    for names, group in _by_header(spark, paths).items():
        if set(NEEDED) <= set(names):
            out = out.unionByName(_parsed(spark, names, group, checked=True))
        elif names:
            lines = [(path.rsplit("/", 1)[-1], first_line(spark, path), HEADER) for path in group]
            refused = spark.createDataFrame(lines, f"file_name string, {BAD_ROW} string, _fault string")
            named = refused.withColumn("file_period", period_of(F.col("file_name")))
            out = out.unionByName(named, allowMissingColumns=True)
    return out


def trips_of(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("_fault").isNull()).drop(BAD_ROW, "_fault")


def rejects_of(checked: DataFrame) -> DataFrame:
    """file_name, row (its text) and fault of the rows that are no trips."""
    bad = checked.filter(F.col("_fault").isNotNull())
    return bad.select("file_name", F.col(BAD_ROW).alias("row"), F.col("_fault").alias("fault"))


def list_trip_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Name, size and path of the wanted files; their content is not read."""
    files = spark.read.format("binaryFile").options(**LISTING).load(path)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", "path")
    return named.filter(~F.col("file_name").startswith(OTHER_SYSTEM))


def _paths(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    wanted = list_trip_files(spark, path if isinstance(path, str) else list(path))
    return [row.path for row in wanted.select("path").orderBy("path").collect()]


def scan_trip_files(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Raw trips of all wanted files under ``path``, with ``file_name`` and ``file_period``.

    With ``columns`` only these are parsed; a row's number of fields is then not looked at, and
    what a row lacks is NULL.
    """
    paths = _paths(spark, path)
    if columns is None:
        return trips_of(checked_rows(spark, paths))
    out = _nothing(spark).select(*columns, "file_name", "file_period")
    for names, group in _by_header(spark, paths).items():
        if set(NEEDED) <= set(names):
            out = out.unionByName(_parsed(spark, names, group, checked=False).select(*columns, "file_name", "file_period"))
    return out


def rejected_rows(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The rows of the wanted files that are no trips, and the headers of refused files."""
    return rejects_of(checked_rows(spark, _paths(spark, path)))
