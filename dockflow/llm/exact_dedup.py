"""Exact duplicates, with heavy hitters split off.

Texts are equal when identical after lower-casing A-Z. The digests are written once as a slim
table. Misra-Gries summaries of its partitions, merged, name every digest with more than
1/(counters+1) of the rows; their winners are counted exactly and, `counters` rows at most, are
broadcast, so rows of large groups never meet in one task. All other digests are grouped by an
ordinary shuffle: their groups are smaller than that share by the summary's guarantee.

Null text counts as empty. Of equal texts the row with the largest doc_id stays, a null id being
the smallest. Rows that repeat both text and doc_id get equal results, and `drop_exact_copies`
keeps one of them. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import keep_rows, keyed, written
from dockflow.llm.textbytes import text_of

COUNTERS = 1000


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lowered = pc.cast(pc.ascii_lower(text_of(batch)), pa.large_binary())
        digest = pa.array([hashlib.sha256(x.as_buffer()).digest() for x in lowered], pa.binary())
        yield pa.RecordBatch.from_arrays([text_of(batch, "doc_id"), text_of(batch, "text_key"), digest], ["doc_id", "text_key", "digest"])


def digests(docs: DataFrame) -> DataFrame:
    return keyed(docs).mapInArrow(_digests, "doc_id long, text_key long, digest binary")


def misra_gries(items: Iterator, counters: int) -> dict:
    """Counts that are too low by len(items)/(counters+1) at most; what is above that is in it."""
    counts: dict = {}
    for x in items:
        if x in counts:
            counts[x] += 1
        elif len(counts) < counters:
            counts[x] = 1
        else:
            counts = {k: n - 1 for k, n in counts.items() if n > 1}
    return counts


def frequent(slim: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most `counters` digests, all those with over 1/(counters+1) of the rows among them."""

    def summary(batches):
        counts = misra_gries((x for b in batches for x in b.column(0).to_pylist()), counters)
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["digest", "low"])

    merged = slim.select("digest").mapInArrow(summary, "digest binary, low long").groupBy("digest").agg(F.sum("low").alias("low"))
    top = merged.orderBy(F.desc("low"), "digest").limit(counters + 1).collect()  # bounded: counters + 1 rows
    rest = top[counters].low if len(top) > counters else 0
    rows = [(bytes(r.digest),) for r in top if r.low > max(rest, 1)]
    return slim.sparkSession.createDataFrame(rows, "digest binary")


def groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, text_key, digest, keep_id, keep_key, group_size."""
    slim = written(digests(docs), "digests")
    names = frequent(slim, counters)
    group = [
        F.max(F.struct("doc_id", "text_key")).alias("keep"),
        F.count(F.lit(1)).alias("group_size"),
    ]
    winners = written(slim.join(F.broadcast(names), "digest").groupBy("digest").agg(*group), "winners")
    heavy = slim.join(F.broadcast(winners), "digest")
    rest = slim.join(F.broadcast(names), "digest", "left_anti").repartition("digest")
    light = rest.join(rest.groupBy("digest").agg(*group), "digest")
    return heavy.unionByName(light).select(
        "doc_id", "text_key", "digest", F.col("keep.doc_id").alias("keep_id"), F.col("keep.text_key").alias("keep_key"), "group_size"
    )


def exact_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    return groups(docs, counters).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_exact_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents without copies, all columns kept."""
    found = groups(docs, counters)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_key") == F.col("keep_key")))
    return keep_rows(docs, kept)
