"""Sharding of records into ranges of a key whose sizes are near equal.

Splitters come from a sample of the keys in which a row's chance grows with its size (and a little
with its being a row, so that ranges hold bounded numbers of rows too). Every `DRAWS`-th sampled
place is a boundary; the ranges between boundaries are then measured over all rows, and an overfull
one is sampled again, denser, and subdivided. A place is (key, doc_id, row): a boundary in a key of
many rows cuts that key by doc_id; one in another key stands before the key.

Ranges only deal out the work. What a shard gets depends on the rows alone: rows lie end to end in
the order of their places, and a row belongs to the shard in which its middle byte lies. Rows of
one key move together, by the middle of the key, unless the key holds more than `TOGETHER` of a
shard's due share of bytes or rows; such a key is cut where a shard ends. So a shard is off its
due by at most half a row, or half of `TOGETHER`, at either end.

The key is a hash of the text unless the caller gives one, so equal texts share a shard as far as
that bound allows. A null text counts as empty (size 1), a null doc_id as the smallest. Repeated
rows are rows of one place, in any order. Long texts are one row and are not cut: a row larger than
a shard's due fills its shard, and shards beside it may stay empty. No rows: no result. Only doc_id
and text (or what `key` and `size` name) are read; other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.llm.common import same_row, text_key, written

#: A range of the first cut for so many bytes, and at least so many for a shard.
RANGE_BYTES, RANGES_PER_SHARD = 1 << 30, 32
#: Sampled places between two boundaries.
DRAWS = 32
#: Keys of more than this part of a shard's due share, in bytes or rows, may be cut.
TOGETHER = 0.01
#: A range of more than so many times its due is subdivided, in at most so many rounds.
OVERFULL, ROUNDS, DENSER = 2.0, 3, 4
LEAST = -(1 << 63)
PLACE = ["key", "id", "row"]


def digest_key(text: str = "text") -> Column:
    """The first 60 bits of the text's MD5."""
    whole = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return F.conv(F.substring(whole, 1, 15), 16, 10).cast("long")


def _slim(docs: DataFrame, key: Column, size: Column) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"), text_key().alias("text_key"), size.cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        key.alias("key"), F.coalesce(doc_id, F.lit(LEAST)).alias("id"), F.monotonically_increasing_id().alias("row"),
    )
    return written(rows, "sizes")


def _sampled(rows: DataFrame, draws: float, n_rows: int, n_bytes: int, seed: int) -> DataFrame:
    """About `draws` places; a row's chance is the mean of its parts of all bytes and of all rows."""
    chance = (F.col("size") / F.lit(float(n_bytes)) + F.lit(1.0 / n_rows)) * F.lit(draws / 2)
    even = F.xxhash64(F.lit(seed), *PLACE).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    return rows.where(even < chance)


def _boundaries(sample: DataFrame, every: int, hot: DataFrame, within: list[str]) -> DataFrame:
    """Each `every`-th place of the sample; before the key, unless the key may be cut."""
    order = Window.partitionBy(*within).orderBy(*PLACE) if within else Window.orderBy(*PLACE)
    chosen = sample.withColumn("nth", F.row_number().over(order)).where(F.col("nth") % every == 0)
    cut = chosen.join(F.broadcast(hot), "key", "left")
    inside = [F.when(F.col("hot"), F.col(c)).otherwise(F.lit(LEAST)).alias(c) for c in ("id", "row")]
    return cut.select("key", *inside)


def _ranged(rows: DataFrame, splitters: DataFrame, n: int) -> DataFrame:
    """The rows with the number of splitters at or before their place: a binary search in the one
    sorted array, which is a scalar of the plan."""
    if not n:
        return rows.withColumn("cell", F.lit(0))
    sorted_places = splitters.agg(F.array_sort(F.collect_list(F.struct(*PLACE)))).scalar()
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(n.bit_length()))))

    def further(at: Column, step: Column) -> Column:
        return F.when(F.get("places", at + step - 1) <= F.struct(*PLACE), at + step).otherwise(at)

    return rows.withColumn("places", sorted_places).withColumn("cell", F.aggregate(steps, F.lit(0), further)).drop("places")


def _cells(rows: DataFrame) -> DataFrame:
    return rows.groupBy("cell").agg(F.sum("size").alias("cell_bytes"), F.count(F.lit(1)).alias("cell_rows"))


def shard(docs: DataFrame, shards: int = 8, key: Column | None = None, size: Column | None = None, range_bytes: int = RANGE_BYTES, seed: int = 1) -> DataFrame:
    """doc_id, text_key, size, text_crc32, key, shard (0 to shards - 1), slot (0, 1, … in a shard, by
    place) and cell (the range) of every row. `size` is UTF-8 bytes plus 1 unless given; it must be above 0."""
    if shards < 1:
        raise ValueError("at least one shard")
    key = digest_key() if key is None else key
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 1 if size is None else size
    rows = _slim(docs, key, size)
    n_rows, n_bytes = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    due = max(1, -(-n_bytes // shards))
    if not n_rows:
        return rows.select("doc_id", "text_key", "size", "text_crc32", "key", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), F.lit(0).alias("cell"))

    # At most 2 * shards / TOGETHER keys hold so much.
    most_bytes, most_rows = due * TOGETHER, max(1.0, n_rows / shards * TOGETHER)
    per_key = rows.groupBy("key").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    hot = written(per_key.where((F.col("b") > most_bytes) | (F.col("n") > most_rows)).select("key", F.lit(True).alias("hot")), "hot_keys")

    ranges = max(shards * RANGES_PER_SHARD, n_bytes // range_bytes)
    draws = float(ranges * DRAWS)
    splitters = written(_boundaries(_sampled(rows, draws, n_rows, n_bytes, seed), DRAWS, hot, []).distinct(), "splitters")
    n = splitters.count()
    cells = written(_cells(_ranged(rows, splitters, n)), "cells")
    for again in range(1, ROUNDS + 1):
        weight = F.col("cell_bytes") / float(n_bytes) + F.col("cell_rows") / float(n_rows)
        overfull = cells.where((weight > 2 * OVERFULL / ranges) & (F.col("cell_rows") > 1)).select("cell")
        if overfull.isEmpty():
            break
        inside = _ranged(rows, splitters, n).join(F.broadcast(overfull), "cell")
        more = _boundaries(_sampled(inside, draws * DENSER**again, n_rows, n_bytes, seed + again), DRAWS * DENSER**again // 2, hot, ["cell"])
        splitters = written(splitters.union(more).distinct(), "splitters")
        if (found := splitters.count()) == n:
            break
        n = found
        cells = written(_cells(_ranged(rows, splitters, n)), "cells")

    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    begun = cells.select("cell", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(a) for c, a in (("cell_bytes", "bytes_before"), ("cell_rows", "rows_before"))))
    by_place = Window.partitionBy("cell").orderBy(*PLACE)
    same_key = Window.partitionBy("cell", "key")
    start = F.col("bytes_before") + F.sum("size").over(by_place.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    lined = (
        _ranged(rows, splitters, n).join(F.broadcast(begun), "cell").join(F.broadcast(hot), "key", "left")
        .withColumn("start", start).withColumn("nth", F.col("rows_before") + F.row_number().over(by_place) - 1)
    )
    middle = F.when(F.col("hot"), F.col("start") + F.expr("size div 2")).otherwise(F.min("start").over(same_key) + F.floor(F.sum("size").over(same_key) / 2))
    dealt = written(lined.select("doc_id", "text_key", "size", "text_crc32", "key", "nth", "cell", F.floor(middle / F.lit(due)).cast("int").alias("shard")), "dealt")
    first = dealt.groupBy("shard").agg(F.min("nth").alias("first"))
    return dealt.join(F.broadcast(first), "shard").select("doc_id", "text_key", "size", "text_crc32", "key", "shard", (F.col("nth") - F.col("first")).alias("slot"), "cell")


def write_shards(docs: DataFrame, path: str, shards: int = 8, **how) -> None:
    """All rows of docs as Parquet, in one folder for each shard (`shard=…`), each range a file in it.
    Repeated rows are told apart by a number, so each is written once."""
    placed = shard(docs, shards, **how)
    number = lambda by: F.row_number().over(Window.partitionBy("text_key", "doc_id").orderBy(by))
    there = placed.select("doc_id", "text_key", "shard", "slot", "cell", number("slot").alias("copy"))
    held = docs.select(F.struct("*").alias("held"), F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"))
    held = held.withColumn("copy", number(F.lit(0)))
    both = held.join(there, same_row(held, there) & (held.copy == there.copy)).select("held", there.shard, there.slot, there.cell)
    ranges = both.repartition("shard", "cell").sortWithinPartitions("shard", "slot")
    clash = {"shard", "slot", "cell"} & set(docs.columns)
    columns = [F.col(f"held.`{c}`").alias(f"own_{c}" if c in clash else c) for c in docs.columns]
    ranges.select(*columns, "slot", "shard").write.partitionBy("shard").parquet(path)
