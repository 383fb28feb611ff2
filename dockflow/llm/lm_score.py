"""Texts scored by stupid backoff over word bigrams of the whole collection.

S(w | v) = f(v w) / f(v) if the bigram is seen at least `least` times, else ALPHA * f(w) / N; a text's first
word has f(w) / N. A text's score is the sum of the logarithms; all counts cover all texts.

Counts and joins are by hash: unigram counts are a table; bigrams are exploded, dealt out by hash,
and meet their counts in the task of their hash range; what that gives is summed per document.
Bigrams travel in blocks of some thousand texts: one row holds the distinct words and bigrams of a block
that fall into one range, sorted and packed. The rows of the unigram table are dealt to the same ranges.
A range answers each block with the counts of the names it sent, in their order. The block's texts, as
numbers of its words, cross the same exchange once and wait there for the answers. So what is written is in
proportion to the words, however many ranges there are, and no task or driver holds the vocabulary.
Of more than `most` words in all, the bigrams are joined as rows by plain shuffles (`joined_scores`, the
same result).

Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z. Null and empty texts have no words, log_score 0
and mean 0. Repeated rows score alike. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import keyed, pieces, text_key, written
from dockflow.llm.textbytes import U, mix, text_of, word_hashes

ALPHA, LEAST = 0.4, 2
BLOCK_WORDS, RANGE_WORDS, HELD_WORDS = 1_000_000, 1_500_000, 1_500_000
#: With more ranges a block's rows would be too short to be worth packing.
MOST_RANGES = 1 << 14
#: Words of all texts that are dealt out packed.
MOST_ROWS = MOST_RANGES * RANGE_WORDS
#: In place of a block's number: rows of the unigram table.
TABLE = -1
#: Marks the row of a block that holds its documents.
ROWS = b"rows"


def _pairs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and second word's index of every bigram, and the text it is in."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(owner[1:] == owner[:-1]) + 1
    return mix(words[at - 1] * U(0x9E3779B97F4A7C15) + words[at]), at, owner[at]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    names, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return names, np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def out():
        names, n = _merged(held)
        return pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n)], ["word", "n"])

    for batch in batches:
        for piece in pieces(batch):
            held.append(np.unique(word_hashes(text_of(piece))[0], return_counts=True))
            if sum(len(h[0]) for h in held) > HELD_WORDS:
                held = [_merged(held)]
                if len(held[0][0]) > HELD_WORDS // 2:
                    yield out()
                    held = []
    if held:
        yield out()


def unigrams(docs: DataFrame) -> DataFrame:
    """(word, n) for every distinct word of the texts, as a written table."""
    return written(docs.select("text").mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "unigrams")


def _pack(*arrays: np.ndarray) -> bytes:
    """Compressed by byte planes: the high bytes of numbers, mostly alike, lie together."""
    raw = b"".join(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(np.array([len(a) for a in arrays], np.int64).tobytes() + raw)


def _unpack(data: bytes, *kinds: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    at, out = 8 * len(kinds), []
    for n, kind in zip(np.frombuffer(raw, np.int64, len(kinds)).tolist(), map(np.dtype, kinds), strict=True):
        out.append(np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n).T.copy().view(kind).reshape(-1))
        at += n * kind.itemsize
    return out


def _apart(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def _together(gaps: np.ndarray) -> np.ndarray:
    return np.cumsum(gaps, dtype=gaps.dtype)


def _scores(docs: DataFrame, counts: DataFrame, total: int, least: int) -> DataFrame:
    ranges = max(1, -(-total // RANGE_WORDS))
    width = (1 << 64) // ranges + 1

    def cuts(names: np.ndarray) -> list[int]:
        """Where each range begins in sorted names, and their end."""
        return [0, *np.searchsorted(names, np.array([r * width for r in range(1, ranges)], dtype=U)).tolist(), len(names)]

    def dealt(rows: list[tuple[int, bytes]], block: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int64()), pa.array([block] * len(rows), pa.int64()), pa.array([p for _, p in rows], pa.binary())], ["part", "block", "packed"])

    def deal(batches):
        """The unigram table by ranges."""
        held = []

        def out():
            words, n = (np.concatenate(x) for x in zip(*held, strict=True))
            by = np.argsort(words)
            words, n = words[by], n[by]
            at = cuts(words)
            return dealt([(r, _pack(_apart(words[a:b]), n[a:b])) for r, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a], TABLE)

        for batch in batches:
            held.append((text_of(batch, "word").to_numpy().view(U), text_of(batch, "n").to_numpy()))
            if sum(len(h[0]) for h in held) >= HELD_WORDS:
                yield out()
                held = []
        if held:
            yield out()

    def block(held: list[tuple], number: int) -> pa.RecordBatch:
        """What the block asks each range, and under a part of its own its documents and its words in order."""
        n_words = np.concatenate([np.diff(h[3]) for h in held])
        word = np.concatenate([h[2] for h in held])
        pair = _pairs(word, np.append(0, np.cumsum(n_words)))[0]
        words, at, n = np.unique(word, return_inverse=True, return_counts=True)
        by = np.argsort(-n, kind="stable")  # common words get small numbers
        place = np.empty(len(by), np.uint32)
        place[by] = np.arange(len(by), dtype=np.uint32)
        mine = -1 - number
        out = [(mine, _pack(_apart(words[by]), place[at]))]
        table = pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(h[0]) for h in held]), pa.array(np.concatenate([h[1] for h in held])), pa.array(n_words)], ["doc_id", "text_key", "n"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as w:
            w.write_batch(table)
        out.append((mine, ROWS + sink.getvalue().to_pybytes()))
        pairs, n = np.unique(pair, return_counts=True)
        of_words, of_pairs = cuts(words), cuts(pairs)
        for r in range(ranges):
            (a, b), (i, j) = of_words[r : r + 2], of_pairs[r : r + 2]
            if b > a or j > i:
                out.append((r, _pack(_apart(words[a:b]), _apart(pairs[i:j]), n[i:j].astype(np.uint32))))
        return dealt(out, number)

    def explode(batches):
        held, number = [], TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in pieces(batch):
                words, first = word_hashes(text_of(piece))
                held.append((text_of(piece, "doc_id"), text_of(piece, "text_key").to_numpy(), words, first))
                if sum(len(h[2]) for h in held) >= BLOCK_WORDS:
                    yield block(held, number)
                    held, number = [], number + 1
        if held:
            yield block(held, number)

    def meet(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        """The counts of the words and bigrams that each block has in a range."""
        table = [_unpack(data, U, np.int64) for _, number, data in held if number == TABLE]
        asked = [(number, *_unpack(data, U, U, np.uint32)) for _, number, data in held if number != TABLE]
        known = np.concatenate([_together(t[0]) for t in table] or [np.zeros(0, U)])
        by = np.argsort(known)
        known, n = known[by], np.concatenate([t[1] for t in table] or [np.zeros(0, np.int64)])[by]
        at = np.unique(np.concatenate([_together(x[2]) for x in asked]), return_inverse=True)[1]
        f2 = np.bincount(at, np.concatenate([x[3] for x in asked])).astype(np.int64)[at]
        ends = np.cumsum([len(x[2]) for x in asked])
        out = [_pack(n[np.searchsorted(known, _together(words))], f2[end - len(pairs) : end]) for (_, words, pairs, _), end in zip(asked, ends.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([-1 - x[0] for x in asked], pa.int64()), pa.array([held[0][0]] * len(out), pa.int64()), pa.array(out, pa.binary())], ["part", "range", "packed"])

    def by_range(batches):
        """Batches sorted by part; the rows of a range go to `meet` together."""
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(text_of(batch, k).to_pylist() for k in ("part", "block", "packed")), strict=True):
                if held and held[0][0] != row[0]:
                    yield meet(held)
                    held = []
                if row[0] >= 0:
                    held.append(row)
        if held:
            yield meet(held)

    def whole(rows: pa.Table, answers: pa.Table) -> pa.Table:
        """The documents of a block: the sums over their words, of the counts that all ranges answered."""
        names = ["doc_id", "text_key", "n_words", "log_score"]
        if not rows.num_rows or rows["part"][0].as_py() >= 0:
            return pa.table([pa.array([], kind) for kind in (pa.int64(), pa.int64(), pa.int64(), pa.float64())], names)
        parts = rows["packed"].to_pylist()
        (table,) = (b for data in parts if data[:4] == ROWS for b in pa.ipc.open_stream(data[4:]))
        ((words, at),) = (_unpack(data, U, np.uint32) for data in parts if data[:4] != ROWS)
        words, n_words = _together(words), table["n"].to_numpy()
        first = np.append(0, np.cumsum(n_words))
        counts = [_unpack(data, np.int64, np.int64) for _, data in sorted(zip(answers["range"].to_pylist(), answers["packed"].to_pylist(), strict=True))]
        f1, f2 = (np.concatenate([c[k] for c in counts] or [np.zeros(0, np.int64)]) for k in (0, 1))
        pair, after, owner = _pairs(words[at], first)
        pairs, kind = np.unique(pair, return_inverse=True)
        if (len(f1), len(f2)) != (len(words), len(pairs)):
            raise ValueError("the answers are not those of this block")
        n = np.empty(len(words), np.int64)
        n[np.argsort(words)] = f1
        f, left, right = f2[kind], n[at[after - 1]], n[at[after]]
        sums = np.bincount(owner, np.where(f >= least, np.log(f) - np.log(left), np.log(ALPHA * right / total)), len(n_words)).astype(float)  # without bigrams it counts in integers
        begun = n_words > 0
        sums[begun] += np.log(n[at[first[:-1][begun]]] / total)
        return pa.table([table["doc_id"], table["text_key"], table["n"], pa.array(sums)], names)

    blocks = keyed(docs).mapInArrow(explode, "part long, block long, packed binary")
    dealt_out = blocks.unionByName(counts.mapInArrow(deal, "part long, block long, packed binary")).repartition(ranges, "part")
    answers = dealt_out.sortWithinPartitions("part").mapInArrow(by_range, "part long, range long, packed binary").repartition(ranges, "part")
    # Both sides read the one exchange; documents of a block are in the partition of their part.
    return dealt_out.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(whole, "doc_id long, text_key long, n_words long, log_score double")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, most=1 << 20):
            words, first = word_hashes(text_of(piece))
            pair, at, owner = _pairs(words, first)
            begin = np.flatnonzero(np.diff(first) > 0)
            owner = np.concatenate([owner, begin])
            row = pa.array(owner)
            start = words[first[begin]].view(np.int64)
            before, after = (np.concatenate([x, start]) for x in (words[at - 1].view(np.int64), words[at].view(np.int64)))
            mask = np.concatenate([np.zeros(len(at), bool), np.ones(len(begin), bool)])
            hashed = np.concatenate([pair.view(np.int64), np.zeros(len(begin), np.int64)])
            yield pa.RecordBatch.from_arrays([text_of(piece, "doc_id").take(row), text_of(piece, "text_key").take(row), pa.array(before, mask=mask), pa.array(after), pa.array(hashed, mask=mask)], ["doc_id", "text_key", "v", "w", "pair"])


def joined_scores(docs: DataFrame, counts: DataFrame, total: int, least: int) -> DataFrame:
    """The same by plain joins: for collections of too many words to be dealt out packed."""
    rows = keyed(docs).mapInArrow(_rows, "doc_id long, text_key long, v long, w long, pair long").groupBy("doc_id", "text_key", "v", "w", "pair").agg(F.count(F.lit(1)).alias("n"))
    same = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key")).groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    seen = rows.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("f2")).where(F.col("f2") >= least)
    one = lambda k: counts.select(F.col("word").alias(k), F.col("n").alias(f"f_{k}"))
    met = rows.join(one("w"), "w").join(one("v"), "v", "left").join(seen, "pair", "left")
    log = (
        F.when(F.col("v").isNull(), F.log(F.col("f_w") / total))
        .when(F.col("f2").isNotNull(), F.log(F.col("f2")) - F.log(F.col("f_v")))
        .otherwise(F.log(ALPHA * F.col("f_w") / total))
    )
    sums = met.groupBy("doc_id", "text_key").agg(F.sum(F.col("n") * log).alias("sum"), F.sum("n").alias("words"))
    sums = sums.toDF("own_id", "own_key", "sum", "words")
    out = same.join(sums, (same.text_key == sums.own_key) & same.doc_id.eqNullSafe(sums.own_id), "left")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return out.select(each.alias("copy"), "doc_id", "text_key", F.coalesce(F.expr("words div copies"), F.lit(0)).alias("n_words"), F.coalesce(F.col("sum") / F.col("copies"), F.lit(0.0)).alias("log_score")).drop("copy")


def scores(docs: DataFrame, least: int = LEAST, most: int = MOST_ROWS) -> DataFrame:
    """doc_id, text_key, n_words, log_score and mean (log_score per word) of every row."""
    counts = unigrams(docs)
    total = counts.agg(F.sum("n")).first()[0] or 0
    way = _scores if total <= most else joined_scores
    found = way(docs, counts, total or 1, least)
    return found.withColumn("mean", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).otherwise(0.0))
