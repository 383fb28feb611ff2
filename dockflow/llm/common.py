"""What the operators share: the shared folder, row keys, Arrow batches in bounded pieces.

A row of `documents` is named by `doc_id` and `text_key`, a hash of its text. Rows that agree in
both are repeated rows: every operator gives them the same result. A null `doc_id` is a value
like any other here; the text's hash spreads such rows over tasks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 20
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a session without one must be local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="dockflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage is cut, and a lost executor costs nothing."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_key(text: str | Column = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text_key, text (null: empty) and the named columns; nothing else is read."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("text_key"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *more,
    )


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return (left.text_key == right.text_key) & left.doc_id.eqNullSafe(right.doc_id)


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of docs named by (doc_id, text_key) in kept, once each, with all their columns."""
    held = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"))
    kept = kept.select("doc_id", "text_key").distinct()
    once = Window.partitionBy(held.text_key, held.doc_id).orderBy(held.doc_id)
    return (
        held.join(kept, same_row(held, kept))
        .select("row", F.row_number().over(once).alias("copy"))
        .where("copy = 1")
        .select("row.*")
    )


def lower_ascii(text: Column) -> Column:
    """A-Z only; a text without other letters takes the fast built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, *LOWER))


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows of about `most` bytes of text; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield batch.slice(start)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's source to the executors, for sessions that were started without it."""
    import shutil
    from pathlib import Path

    package = Path(__file__).resolve().parents[1]
    if (app := spark.sparkContext.applicationId) not in _SHIPPED:
        _SHIPPED.add(app)
        source = Path(tempfile.mkdtemp(prefix="dockflow-source-"))
        shutil.copytree(package, source / "tree" / package.name, ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(str(source / package.name), "zip", source / "tree"))
