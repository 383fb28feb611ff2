"""Fill-in-the-middle: texts cut into prefix, middle and suffix and put into another order.

A text is a row of units (here single code points; any pattern that matches everything, such as
words with their blanks, will do). Over the units lies an indexable skip list: each lane above
the lowest keeps about every fourth node of the lane below, and each of its links carries two
widths, the units and the code points that it passes. Going down from the top lane, adding widths
while the units stay within the wanted rank, ends exactly at that rank, and the sum of the other
width is the place in the text.

Where a text is cut and which form it takes follow from a digest of doc_id alone, so repeated rows
and rows of one doc_id are cut by the same numbers and results don't depend on partitions. Null
and empty texts, and texts that contain a marker, stay plain. A null doc_id is digested as empty
text. Every row gives one row; very long texts are handled one at a time. Only doc_id and text are
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import pieces
from dockflow.llm.textbytes import U, mix, text_of

# The markers, and the shares of cut texts and of suffix-first texts in per cent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT, SUFFIX_FIRST = 90, 20
POINT = "(?s:.)"
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@lru_cache(maxsize=32)
def _tall(bits: int) -> np.ndarray:
    """The nodes below 2**bits that reach the next lane: the first, and about every fourth."""
    tall = (mix(np.arange(1 << bits, dtype=U)) & U(3)) == 0
    tall[0] = True
    return np.flatnonzero(tall)


class Lanes:
    """An indexable skip list over units of the given widths (in code points)."""

    def __init__(self, widths: np.ndarray):
        units = np.ones(len(widths), dtype=np.int64)
        points = np.asarray(widths, dtype=np.int64)
        self.lanes = [(units, points, None)]
        while len(units) > 8:
            kept = _tall(int(len(units)).bit_length())
            kept = kept[: np.searchsorted(kept, len(units))]
            if len(kept) == len(units):
                break
            units, points = np.add.reduceat(units, kept), np.add.reduceat(points, kept)
            self.lanes.append((units, points, kept))

    def reach(self, rank: int) -> int:
        """The code points before the unit of this rank."""
        at = passed = place = 0
        for units, points, down in reversed(self.lanes):
            while at < len(units) and passed + units[at] <= rank:
                passed += int(units[at])
                place += int(points[at])
                at += 1
            if down is not None:
                at = int(down[at]) if at < len(down) else len(self.lanes[0][0])
        if passed != rank:
            raise IndexError(rank)
        return place


def draws(doc_id: int | None) -> list[int]:
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(doc_id: int | None, text: str, unit: str = POINT) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of the prefix, of the middle, output) of one text."""
    h1, h2, h3, h4 = draws(doc_id)
    if unit == POINT:
        n, widths = len(text), np.ones(len(text), dtype=np.int64)
    else:
        widths = np.array([m.end() - m.start() for m in re.finditer(unit, text)], dtype=np.int64)
        n = len(widths)
        if widths.sum() != len(text) or (n and not widths.all()):
            raise ValueError("the units must be the whole text")
    if not text or h3 % 100 >= CUT or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    lanes = Lanes(widths)
    a, b = (lanes.reach(r) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SUFFIX_FIRST:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text, from output and form alone: a marker can't begin inside a part, as none contains one."""
    if form == "plain":
        return output
    head, middle = output.split(MIDDLE)
    if form == "psm":
        prefix, suffix = head.removeprefix(PREFIX).split(SUFFIX)
    else:
        suffix, prefix = head.removeprefix(SUFFIX).split(PREFIX)
    return prefix + middle + suffix


def _transform(unit: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                ids = text_of(piece, "doc_id").to_pylist()
                rows = [(i, *transform(i, t, unit)) for i, t in zip(ids, text_of(piece).to_pylist(), strict=True)]
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "output"):
            back = [restore(o, f) for o, f in zip(text_of(piece, "output").to_pylist(), text_of(piece, "form").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(back, pa.string())], [*piece.schema.names, "restored"])


def fill_in_middle(docs: DataFrame, unit: str = POINT) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and the output of every row."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return slim.mapInArrow(_transform(unit), SCHEMA)


def restored(output: DataFrame) -> DataFrame:
    """The rows of `fill_in_middle` with the text they were made from, rebuilt from output and form."""
    return output.mapInArrow(_restore, f"{SCHEMA}, restored string")
