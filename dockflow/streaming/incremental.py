"""Loading only the files that are new.

A file is known by its name. Of files with one name the first counts: one in the table before any
other, then the one whose path comes first. The wanted files are listed and set against the
table's manifest, however old they are; those not in it are read and written as loads of the
table, each entered into the manifest when it is complete. A run that dies leaves rows that no
reader sees, and the next run takes its files again; of two runs at once that take the same file,
one counts. A file without rows is entered like any other. Rows that are no trips, and headers
without the columns a trip needs, stop no load: they go to the table's rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from dockflow.sources.files import checked_rows, list_trip_files, rejects_of, trips_of, with_status
from dockflow.sources.table import append_load, manifest, new_generation, publish, table_rows, write_to


def load_plan(spark: SparkSession, files: str, table: str, afresh: bool = False) -> DataFrame:
    """Every wanted file as ``new``, ``skipped`` (its name is in the table) or ``repeated`` (another
    new file of the listing has its name), before a load."""
    listed = list_trip_files(spark, files)
    known = manifest(spark, table).select("file_name").distinct().withColumn("known", F.lit(True))
    joined = listed.join(known.limit(0) if afresh else known, "file_name", "left")
    return with_status(joined, F.col("known")).select("file_name", "length", "status", "path")


def _load(spark: SparkSession, part: list[Row], write) -> None:
    """Read some files and hand them to ``write`` (trips, files, rejects); the rows are parsed once
    more only if some are no trips."""
    checked = checked_rows(spark, [f.path for f in part])
    seen = Observation()
    watched = checked.observe(seen, F.count_if(F.col("_fault").isNotNull()).alias("bad"))
    named = spark.createDataFrame([(f.file_name, f.length) for f in part], "file_name string, length long")
    write(table_rows(trips_of(watched)), named, lambda: rejects_of(checked) if seen.get["bad"] else None)


def _new_files(spark: SparkSession, files: str, table: str, afresh: bool) -> list[Row]:
    plan = load_plan(spark, files, table, afresh)
    return plan.where("status = 'new'").orderBy("file_name").collect()


def load_new_files(spark: SparkSession, files: str, table: str, files_per_load: int = 1000) -> None:
    """Append the trips of files not loaded before to ``table``; the list of their names is all that
    the driver holds."""
    new = _new_files(spark, files, table, afresh=False)
    for at in range(0, len(new), files_per_load):
        _load(spark, new[at : at + files_per_load], lambda rows, named, bad: append_load(rows, table, named, bad))


def reload_all_files(spark: SparkSession, files: str, table: str, files_per_load: int = 1000) -> None:
    """Replace ``table`` by the trips of all wanted files; readers keep the old one until it is done."""
    generation = new_generation(spark, table)
    folder = f"{table}/generation={generation}"
    new = _new_files(spark, files, table, afresh=True)
    for at in range(0, len(new), files_per_load):
        _load(spark, new[at : at + files_per_load], lambda rows, named, bad: write_to(folder, rows, named, bad))
    publish(spark, table, generation)
