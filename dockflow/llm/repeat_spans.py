"""Removal of long strings that occur more than once in a collection of texts.

A byte goes if a string of `LENGTH` bytes covers it that also starts anywhere else, in any text,
overlaps included. The strings that are compared are anchored: the `GRAM` bytes of the smallest
hash within a string (the leftmost of equals) are its anchor, so equal strings have equal anchors
at the same place. Consecutive strings of a text with one anchor form a segment; only anchors
that occur twice go on, and segments that are equal as a whole are counted, not gathered.

Where segments of one anchor differ, the collection is built column by column: each round adds
one symbol of every segment to the collection's (positional) Burrows-Wheeler order and updates the
common prefixes of neighbours in it; a string is repeated if the common part that ends at its last
symbol is at least as long. Plain column-wise construction over whole texts takes one pass over
the collection for each byte of the longest text; anchored, there are at most 2 * LENGTH - GRAM
rounds, and only the columns of a few thousand segments are in memory. Anchors with more than
`most` different segments go another exact way: their strings are counted by hash in a shuffle.

Texts are UTF-8 bytes; null counts as empty; texts shorter than LENGTH lose nothing. Repeated rows
are repeated strings and lose all that is long enough. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import keyed, pieces, written
from dockflow.llm.textbytes import U, column_bytes, prefix_hash, span_hash, text_of

LENGTH, GRAM = 400, 32
PIECE = 2 << 20
PLACE = U((1 << 24) - 1)
#: Different segments of an anchor that one task compares.
MOST_SEGMENTS = 8000
#: Segments whose columns are in memory together.
BLOCK_ROWS = 4096
SEGMENT = ["gram", "left", "keep", "digest"]


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` consecutive keys."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=U)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def segments(data: np.ndarray, at: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Of all texts: anchor, first and last string start (bytes of `data`), hash of the anchor, hash
    of the segment. A run of starts that crosses a chunk of a very long text makes two segments."""
    out = []
    step = 1 << 22
    width = length - GRAM + 1
    for low in range(0, max(len(data) - length + 1, 0), step):
        part = data[low : low + step + length - 1]
        prefix = prefix_hash(part)
        first = np.arange(len(part) - GRAM + 1)
        gram = span_hash(prefix, first, first + GRAM)
        anchor = (_smallest((gram & ~PLACE) | first.astype(U), width) & PLACE).astype(np.int64)
        inside = np.zeros(len(anchor) + 1, dtype=np.int64)
        begin, end = np.clip(at[:-1] - low, 0, len(anchor)), np.clip(at[1:] - length + 1 - low, 0, len(anchor))
        ok = end > begin
        np.add.at(inside, begin[ok], 1)
        np.add.at(inside, end[ok], -1)
        starts = np.flatnonzero(np.cumsum(inside[:-1]))
        if not len(starts):
            continue
        owner = anchor[starts]
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)])
        s = starts[new]
        e = starts[np.concatenate([new[1:], [True]])]
        a = owner[new]
        out.append((a + low, s + low, e + low, gram[a], span_hash(prefix, s, e + length)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, U), np.zeros(0, U))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _find(length: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, most=PIECE):
                data, at = column_bytes(text_of(piece))
                anchor, s, e, gram, digest = segments(data, at, length)
                text = np.searchsorted(at, s, side="right") - 1
                row = pa.array(text)
                yield pa.RecordBatch.from_arrays([
                    text_of(piece, "doc_id").take(row), text_of(piece, "text_key").take(row), pa.array(anchor - at[text]), pa.array(gram.view(np.int64)),
                    pa.array((anchor - s).astype(np.int32)), pa.array((anchor - e).astype(np.int32)), pa.array(digest.view(np.int64)),
                ], ["doc_id", "text_key", "anchor", *SEGMENT])

    return find


def _cut_out(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = text_of(batch).to_pylist()
            rows = [(w["gram"], w["left"], w["keep"], w["digest"], w["n_kinds"], t[w["anchor"] - w["left"] : w["anchor"] - w["keep"] + length])
                    for t, wanted in zip(text, text_of(batch, "wanted").to_pylist(), strict=True) for w in wanted]
            for i in range(0, max(len(rows), 1), 20_000):
                own = list(zip(*rows[i : i + 20_000], strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(own, kinds, strict=True)], [*SEGMENT, "n_kinds", "bytes"])

    return cut


def repeated_starts(group: np.ndarray, low: np.ndarray, high: np.ndarray, symbols: np.ndarray, length: int) -> np.ndarray:
    """Rows x start columns: whether the string that starts there also occurs in another row of the
    row's group, at the same column. Row r has symbols in columns low[r] to high[r]; groups ascend.

    `order` is the collection's order by what precedes the column, read backwards; `common[i]` is the
    column where the part that row order[i] shares with row order[i - 1] begins. A round sorts by the
    new symbol and takes the latest beginning among the rows between two neighbours."""
    n, columns = symbols.shape
    found = np.zeros((n, columns - length + 1), dtype=bool)
    order = np.arange(n)
    common = np.zeros(n + 1, dtype=np.int64)
    for k in range(columns):
        here = (low[order] <= k) & (k < high[order])
        key = group[order] * 257 + np.where(here, symbols[order, k], 256)
        to = np.argsort(key, kind="stable")
        key, here = key[to], here[to]
        latest = common[to]
        same = np.zeros(n, dtype=bool)
        same[1:] = (key[1:] == key[:-1]) & here[1:]
        far = np.flatnonzero(same[1:] & (to[1:] != to[:-1] + 1)) + 1
        if len(far):
            ends = np.column_stack([to[far - 1] + 1, to[far] + 1]).ravel()
            latest[far] = np.maximum.reduceat(common, ends)[::2]
        latest[~same] = k + 1
        order = order[to]
        common[:-1] = latest
        if k + 1 >= length:
            alike = same & (k + 1 - latest >= length)
            alike[:-1] |= alike[1:]
            found[order[alike], k + 1 - length] = True
    return found


def _compare(length: int):
    """Rows sorted by gram; segments of one gram come together and fit in memory."""
    reach = length - GRAM

    def blocks(held: list[tuple]) -> pa.RecordBatch:
        gram, left, keep, digest, raw = zip(*held, strict=True)
        left, keep = np.array(left), np.array(keep)
        group = np.unique(np.array(gram, dtype=np.int64), return_inverse=True)[1]
        by = np.argsort(group, kind="stable")
        low, high = reach - left, reach + length - keep
        symbols = np.zeros((len(held), reach + length), dtype=np.uint8)
        for i, text in enumerate(raw):
            symbols[i, low[i] : high[i]] = np.frombuffer(text, dtype=np.uint8)
        found = np.zeros((len(held), reach + 1), dtype=bool)
        found[by] = repeated_starts(group[by], low[by], high[by], symbols[by], length)
        edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, begin = np.nonzero(edge == 1)
        _, end = np.nonzero(edge == -1)
        take = lambda x, kind: pa.array([x[i] for i in row], kind)
        return pa.RecordBatch.from_arrays([
            take(gram, pa.int64()), take(left, pa.int32()), take(keep, pa.int32()), take(digest, pa.int64()),
            pa.array(begin - reach, pa.int64()), pa.array(end - 1 - reach, pa.int64()),
        ], [*SEGMENT, "first", "last"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(text_of(batch, k).to_pylist() for k in (*SEGMENT, "bytes")), strict=True):
                if len(held) >= BLOCK_ROWS and held[-1][0] != row[0]:
                    yield blocks(held)
                    held = []
                held.append(row)
        if held:
            yield blocks(held)

    return compare


def _windows(length: int):
    """Hash of every string of a segment, with its place from the anchor."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = column_bytes(text_of(batch, "bytes"))
            prefix = prefix_hash(data)
            left = text_of(batch, "left").to_numpy().astype(np.int64)
            n = left - text_of(batch, "keep").to_numpy() + 1
            row = np.repeat(np.arange(len(batch)), n)
            rank = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = at[row] + rank
            for i in range(0, max(len(row), 1), 200_000):
                cut = slice(i, i + 200_000)
                own = pa.array(row[cut])
                yield pa.RecordBatch.from_arrays([*(text_of(batch, k).take(own) for k in SEGMENT), pa.array((rank - left[row])[cut]), pa.array(span_hash(prefix, start[cut], start[cut] + length).view(np.int64))], [*SEGMENT, "place", "string"])

    return spread


def repeats(docs: DataFrame, length: int = LENGTH, most: int = MOST_SEGMENTS) -> DataFrame:
    """(doc_id, text_key, spans): per document the byte spans to remove, which may overlap."""
    kinds = "gram long, left int, keep int, digest long"
    found = written(keyed(docs).mapInArrow(_find(length), f"doc_id long, text_key long, anchor long, {kinds}"), "segments")
    first = F.min(F.struct("doc_id", "text_key", "anchor")).alias("sample")
    kept = found.groupBy(*SEGMENT).agg(F.count(F.lit(1)).alias("n"), first)
    per_gram = kept.groupBy("gram").agg(F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("n_kinds")).where("n_all > 1")
    kept = written(kept.join(per_gram, "gram"), "kinds")
    whole = kept.where("n > 1").select(*SEGMENT, (-F.col("left")).cast("long").alias("first"), (-F.col("keep")).cast("long").alias("last"))

    wanted = (
        kept.where("n_kinds > 1").select("sample.*", "n_kinds", *SEGMENT).groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("anchor", "n_kinds", *SEGMENT)).alias("wanted")).toDF("own_id", "own_key", "wanted")
    )
    text = keyed(docs).withColumn("text", F.col("text").cast("binary"))
    there = text.join(wanted, (text.text_key == wanted.own_key) & text.doc_id.eqNullSafe(wanted.own_id)).select("text", "wanted")
    cut = written(there.mapInArrow(_cut_out(length), f"{kinds}, n_kinds long, bytes binary").dropDuplicates(SEGMENT), "cut")
    some = (
        cut.where(F.col("n_kinds") <= most).drop("n_kinds").repartition("gram").sortWithinPartitions("gram")
        .mapInArrow(_compare(length), f"{kinds}, first long, last long")
    )
    spread = cut.where(F.col("n_kinds") > most).drop("n_kinds").mapInArrow(_windows(length), f"{kinds}, place long, string long")
    several = spread.groupBy("gram", "place", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    many = spread.join(several, ["gram", "place", "string"]).select(*SEGMENT, F.col("place").alias("first"), F.col("place").alias("last"))

    runs = whole.unionByName(some).unionByName(many)
    hits = found.join(runs, SEGMENT).select("doc_id", "text_key", F.struct((F.col("anchor") + F.col("first")).alias("start"), (F.col("anchor") + F.col("last") + length).alias("end")).alias("span"))
    return hits.groupBy("doc_id", "text_key").agg(F.collect_set("span").alias("spans"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(text_of(batch, "doc_id").to_pylist(), text_of(batch).to_pylist(), text_of(batch, "spans").to_pylist(), strict=True):
            runs: list[list[int]] = []
            for s in sorted((x["start"], x["end"]) for x in spans or ()):
                if runs and s[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append(list(s))
            edges = [0, *(x for r in runs for x in r), len(text)]
            left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            rows.append((doc_id, len(text), len(text) - len(left), len(runs), left))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, most: int = MOST_SEGMENTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes (binary: a cut may fall inside a character)."""
    found = written(repeats(docs, length, most), "spans").toDF("own_id", "own_key", "spans")
    text = keyed(docs).withColumn("text", F.col("text").cast("binary"))
    both = text.join(found, (text.text_key == found.own_key) & text.doc_id.eqNullSafe(found.own_id), "left").select("doc_id", "text", "spans")
    return both.mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
