"""The trip table: typed trips as Parquet, partitioned by load, file period and month of the start.

Parsed once, read many times: a query reads the two or three columns it needs, and one that
asks for certain months, years or file periods reads only their partitions. Weekday and hours are stored as
numbers, a few bits a row; a query by month, weekday or hour touches no timestamp. Rows without a readable start
are kept, in a partition of their own, since some counts are of all rows of a file.

Any number of writers may work at once, and any of them may die:

* A load has a number that its writer has claimed, and folders of its own for trips (``load=…``),
  the manifest's entries of its files (``_entries``) and rejected rows (``_rejects``). It counts once
  all are written and its number stands in ``_loads``, as one empty file. A number is never used
  twice, so no writer touches what another has written.
* Two incremental loads may take the same new file. Both enter it; the entry of the smaller load
  counts, and readers leave the rows of the other out.
* Replacing the table writes a new generation (``generation=…``) beside the old one. Readers turn
  to it when it is complete and published (``_generations``); until then, and if its writer dies,
  the old one stands. A load that finds its generation replaced is written again to the new one.

A table that was never replaced has no generation folder; its loads lie in the table's own folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockflow.functions.trip import typed, with_calendar, with_numbers
from dockflow.sources.claims import claim, create_once, numbers
from dockflow.sources.schema import TRIP_FILE

PARTITION = ("file_period", "year", "month")
#: `listed`: the load found the file in a listing, and would not have taken one that was known.
MANIFEST = (
    "file_name string, length long, rows long, rejected long, first_start timestamp_ntz, "
    "last_start timestamp_ntz, last_month int, listed boolean, load long"
)
REJECTS = "file_name string, row string, fault string, load long"


def partition_of(rows: DataFrame) -> list[str]:
    return [name for name in PARTITION if name in rows.columns]


def table_rows(raw: DataFrame) -> DataFrame:
    return with_numbers(typed(raw))


def generation_folder(spark: SparkSession, path: str) -> str:
    """Where the loads lie that readers see."""
    published = numbers(spark, f"{path}/_generations")
    return f"{path}/generation={published[-1]}" if published else path


def new_generation(spark: SparkSession, path: str) -> int:
    return claim(spark, f"{path}/_claims/generation")


def publish(spark: SparkSession, path: str, generation: int) -> None:
    """From now on readers see this generation, unless a later one is published already."""
    create_once(spark, f"{path}/_generations/{generation}")


def _read(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _loads(spark: SparkSession, folder: str) -> list[int]:
    return numbers(spark, f"{folder}/_loads")


def _entries(spark: SparkSession, folder: str) -> DataFrame:
    """All entries, with ``counts``: not so if a load took a listed file that an earlier one has."""
    entries = _read(spark, [f"{folder}/_entries/{n}" for n in _loads(spark, folder)], MANIFEST)
    first = F.min("load").over(Window.partitionBy("file_name"))
    return entries.withColumn("counts", ~(F.col("listed") & (F.col("load") > first)))


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    return _entries(spark, folder).filter("counts").drop("counts")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files of the table: name, length (NULL if not known), rows, rejected rows, first and last
    start, last month (YYYYMM), and the load they came in."""
    return _manifest(spark, generation_folder(spark, path))


def next_load(spark: SparkSession, path: str) -> int:
    """The number that the next load will claim, if no other comes first."""
    folder = generation_folder(spark, path)
    return max([0, *numbers(spark, f"{folder}/_claims/load")]) + 1


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        return None


def _figures(stored: DataFrame | None, spark: SparkSession) -> DataFrame:
    """Per file of a written load: rows, first and last start, last month."""
    names = "file_name string, rows long, first_start timestamp_ntz, last_start timestamp_ntz, last_month int"
    if stored is None:
        return spark.createDataFrame([], names)
    named = F.col("file_name") if "file_name" in stored.columns else F.lit(None).cast("string")
    return stored.groupBy(named.alias("file_name")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("started_at").alias("first_start"),
        F.max("started_at").alias("last_start"),
        F.max(F.col("year") * 100 + F.col("month")).alias("last_month"),
    )


def write_to(
    folder: str,
    rows: DataFrame,
    files: DataFrame | None = None,
    rejects: Callable[[], DataFrame | None] = lambda: None,
) -> int:
    """Write one load into a generation's folder and enter it into the manifest; its number.

    ``files`` (file_name, length) are its files; without it, those that the rows name. ``rejects``
    is asked for the rows that are no trips after the trips are written.
    """
    spark = rows.sparkSession
    load = claim(spark, f"{folder}/_claims/load")
    rows.write.mode("overwrite").partitionBy(*partition_of(rows)).parquet(f"{folder}/load={load}")
    bad, at = rejects(), f"{folder}/_rejects/{load}"
    if bad is not None:
        bad.withColumn("load", F.lit(load).cast("long")).write.mode("overwrite").parquet(at)
    bad = _read(spark, [] if bad is None else [at], REJECTS)
    entries = _figures(_stored(spark, f"{folder}/load={load}"), spark)
    if files is None:
        entries = entries.withColumns({"length": F.lit(None).cast("long"), "listed": F.lit(False)})
    else:
        entries = files.withColumn("listed", F.lit(True)).join(entries, "file_name", "left")
    lost = bad.groupBy("file_name").agg(F.count(F.lit(1)).alias("rejected"))
    entries = entries.join(lost, "file_name", "left").withColumn("load", F.lit(load).cast("long"))
    entries = entries.withColumns({name: F.coalesce(name, F.lit(0)) for name in ("rows", "rejected")})
    names = [field.name for field in T.StructType.fromDDL(MANIFEST)]
    entries.select(*names).coalesce(1).write.mode("overwrite").parquet(f"{folder}/_entries/{load}")
    create_once(spark, f"{folder}/_loads/{load}")
    return load


def append_load(
    rows: DataFrame,
    path: str,
    files: DataFrame | None = None,
    rejects: Callable[[], DataFrame | None] = lambda: None,
) -> None:
    """One more load of the table, in the generation that stands when it is done."""
    spark = rows.sparkSession
    folder = None
    while folder != (now := generation_folder(spark, path)):
        folder = now
        write_to(folder, rows, files, rejects)


def write_trips(raw: DataFrame, path: str, gather: bool = True, mode: str = "overwrite") -> None:
    """Write raw trips as the table (``overwrite``) or as one more load (``append``).

    ``gather=True`` brings the rows of a month together, in files of the advisory partition
    size; a month with a large share of all rows is split over many tasks. Rows read from
    monthly files are together already, and can be written without that shuffle.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(mode)
    rows = table_rows(raw)
    if gather:
        rows = rows.hint("rebalance", *partition_of(rows))
    if mode == "append":
        append_load(rows, path)
    else:
        replace_table(path, rows)


def replace_table(path: str, *loads: DataFrame) -> None:
    """A new generation of these loads, in place of all that was in the table."""
    spark = loads[0].sparkSession
    generation = new_generation(spark, path)
    for rows in loads:
        write_to(f"{path}/generation={generation}", rows)
    publish(spark, path, generation)


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is now; what comes later is seen by a later call."""
    return with_calendar(read_loads(spark, generation_folder(spark, path)).drop("load"))


def load_states(spark: SparkSession, folder: str) -> dict[int, str]:
    """The loads that have rows, and for each the files that don't count, as text."""
    per_load = _entries(spark, folder).filter("rows > 0").groupBy("load").agg(
        F.max("counts").alias("any"),
        F.concat_ws("\n", F.array_sort(F.collect_list(F.when(~F.col("counts"), F.col("file_name"))))).alias("hidden"),
    )
    return {row.load: row.hidden for row in per_load.filter("any").orderBy("load").collect()}


def read_loads(spark: SparkSession, folder: str, loads: list[int] | None = None) -> DataFrame:
    """The stored rows of these loads of a generation (of all), with ``load``."""
    states = load_states(spark, folder)
    states = {n: hidden for n, hidden in states.items() if loads is None or n in loads}
    if not states:
        names = "file_name string, file_period string, load long"
        return table_rows(spark.createDataFrame([], TRIP_FILE.simpleString()[7:-1].replace(":", " ") + ", " + names))
    folders = [f"{folder}/load={n}" for n in states]
    schema = spark.read.option("basePath", folder).parquet(*folders).schema
    # A period is text; from the folder names it would be read as a number.
    text = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "file_period" else f for f in schema])
    rows = spark.read.schema(text).option("basePath", folder).parquet(*folders)
    for load, hidden in states.items():
        if hidden:
            beaten = (F.col("load") == load) & F.col("file_name").isin(*hidden.split("\n"))
            rows = rows.filter(~F.coalesce(beaten, F.lit(False)))
    return rows


def rejects(spark: SparkSession, path: str) -> DataFrame:
    """file_name, row, fault and load of every row that was in the table's files but is no trip."""
    folder = generation_folder(spark, path)
    files = _manifest(spark, folder).filter("rejected > 0").select("file_name", "load")
    loads = [r.load for r in files.select("load").distinct().collect()]
    rows = _read(spark, [f"{folder}/_rejects/{n}" for n in loads], REJECTS)
    return rows.join(files, ["file_name", "load"])


def table_figures(spark: SparkSession, path: str) -> DataFrame:
    """rows_loaded, rows_rejected, files, first and last start, and the latest month (YYYYMM), from
    the manifest alone: no trip is read."""
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    return manifest(spark, path).agg(
        total("rows").alias("rows_loaded"),
        total("rejected").alias("rows_rejected"),
        F.countDistinct("file_name").alias("files"),
        F.min("first_start").alias("first_start"),
        F.max("last_start").alias("last_start"),
        F.max("last_month").alias("latest_month"),
    )
