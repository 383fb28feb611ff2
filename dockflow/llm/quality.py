"""Text quality by a generalised additive model with pairwise interactions.

Every text becomes a row of `FEATURES` measured on all its bytes. Training bins each feature by
quantiles and boosts shallow trees in turn over the features, each tree adding to the feature's
lookup table; then the pairs that explain most of what is left get tables of their own, boosted
in the same way. A score is the sum of looked-up values, one addition per feature and pair, for a
whole batch at a time. The model is learned from at most `sample` labelled rows (a documented
bound; the rows with the smallest hash of doc_id); its tables are bounded by bins and pairs.

Null and empty texts have zero in every feature and get the score that this row of bins has.
With no labelled row every score is 0.5. Labels that disagree for a doc_id count by their mean,
1 from one half on; null labels are left out. Repeated rows score alike. Only doc_id and text are
read for scoring.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import pieces
from dockflow.llm.textbytes import LOWER_VALUES, NOT_SPACE, column_bytes, prefix_hash, span_hash, text_of, word_spans

SAMPLE = 20_000
FEATURES = (
    "log_bytes", "words", "word_bytes", "upper", "digits", "stops", "marks", "letters_beyond_ascii",
    "distinct_words", "same_as_before", "bare_marks", "marked_words", "line_bytes", "repeated_lines",
)
BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE, LEAF = 32, 8, 60, 30, 0.15, 20


def _kind(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


UPPER, LETTER, DIGIT, WIDE = _kind((65, 90)), _kind((65, 90), (97, 122), (128, 255)), _kind((48, 57)), _kind((128, 255))
STOP = np.isin(np.arange(256), list(b".,;:"))
MARK = _kind((33, 126)) & ~LETTER & ~DIGIT & ~STOP
NOT_NEWLINE = np.arange(256) != 10


def features(texts: pa.Array) -> np.ndarray:
    """Texts x FEATURES."""
    data, at = column_bytes(texts)
    size = np.diff(at)

    def per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[first])

    def distinct(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.array([len(np.unique(hashes[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)], dtype=float)

    prefix = prefix_hash(data, LOWER_VALUES)
    starts, ends, first = word_spans(data, at, NOT_SPACE)
    words = np.diff(first)
    hashes = span_hash(prefix, starts, ends)
    before = np.zeros(len(hashes), dtype=bool)
    before[1:] = hashes[1:] == hashes[:-1]
    before[first[:-1][words > 0]] = False
    lettered = np.concatenate([[0], np.cumsum(LETTER[data])])
    bare = lettered[ends] == lettered[starts]
    marked = ~bare & MARK[data[ends - 1]] if len(ends) else bare
    line_start, line_end, line_first = word_spans(data, at, NOT_NEWLINE)
    lines = np.diff(line_first)
    share = lambda x, of: x / np.maximum(of, 1)
    return np.column_stack([
        np.log1p(size), np.log1p(words), share(size, words), share(per_text(UPPER[data], at), size), share(per_text(DIGIT[data], at), size),
        share(per_text(STOP[data], at), size), share(per_text(MARK[data], at), size), share(per_text(WIDE[data], at), size),
        share(distinct(hashes, first), words), share(per_text(before, first), words), share(per_text(bare, first), words), share(per_text(marked, first), words),
        np.log1p(share(size, lines)), np.where(lines > 0, 1 - share(distinct(span_hash(prefix, line_start, line_end), line_first), lines), 0.0),
    ]).astype(np.float64)


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(cuts)])


def _step(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A tree of up to three leaves over ordered bins: Newton steps for each bin."""

    def cut(a: int, b: int) -> tuple[float, int]:
        cg, ch, cn = np.cumsum(g[a:b]), np.cumsum(h[a:b]), np.cumsum(n[a:b])
        gain = cg**2 / (ch + 1) + (cg[-1] - cg) ** 2 / (ch[-1] - ch + 1) - cg[-1] ** 2 / (ch[-1] + 1)
        gain[(cn < LEAF) | (cn[-1] - cn < LEAF)] = 0
        best = int(gain.argmax())
        return float(gain[best]), a + best + 1

    edges = [0, len(g)]
    for _ in range(2):
        tried = [cut(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        gain, where = max(tried)
        if gain <= 0:
            break
        edges = sorted([*edges, where])
    out = np.zeros(len(g))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of each axis together: gain, and Newton steps for each cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def corner(c):
        low, row, col = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
        return low, row - low, col - low, c[-1, -1] - row - col + low

    parts = list(zip(corner(cg), corner(ch), strict=True))
    gain = sum(a**2 / (b + 1) for a, b in parts) - cg[-1, -1] ** 2 / (ch[-1, -1] + 1)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    steps = [a[i, j] / (b[i, j] + 1) for a, b in parts]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = steps
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """Tables learned from features x and labels y (0 or 1)."""
    if not len(y):
        return {"cuts": [np.zeros(0)] * len(FEATURES), "start": 0.0, "tables": [np.zeros(1)] * len(FEATURES), "pairs": []}
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    bins = _binned(x, cuts)
    tables = [np.zeros(len(c) + 1) for c in cuts]
    start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    score = np.full(len(y), start)
    counts = [np.bincount(bins[:, k], minlength=len(t)) for k, t in enumerate(tables)]

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-score))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, t in enumerate(tables):
            g, h = slopes()
            step = RATE * _step(np.bincount(bins[:, k], g, len(t)), np.bincount(bins[:, k], h, len(t)), counts[k])
            t += step
            score += step[bins[:, k]]

    def cells(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = len(tables[i]), len(tables[j])
        at = bins[:, i] * shape[1] + bins[:, j]
        g, h = slopes()
        return at, *(np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    found = sorted(((_quadrants(*cells(i, j)[1:])[0], i, j) for i in range(len(tables)) for j in range(i) if len(tables[i]) > 1 < len(tables[j])), reverse=True)
    pairs = [(i, j, np.zeros((len(tables[i]), len(tables[j])))) for gain, i, j in found[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, t in pairs:
            at, g, h = cells(i, j)
            step = RATE * _quadrants(g, h)[1]
            t += step
            score += step.ravel()[at]
    return {"cuts": cuts, "start": start, "tables": tables, "pairs": pairs}


def probability(x: np.ndarray, model: dict) -> np.ndarray:
    bins = _binned(x, model["cuts"])
    score = np.full(len(x), model["start"])
    for k, t in enumerate(model["tables"]):
        score += t[bins[:, k]]
    for i, j, t in model["pairs"]:
        score += t[bins[:, i], bins[:, j]]
    return 1 / (1 + np.exp(-score))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """docs: doc_id and text; labels: doc_id and quality. Only the given rows are used."""
    few = (
        labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )

    def measure(batches):
        for batch in batches:
            for piece in pieces(batch):
                x = features(text_of(piece))
                yield pa.RecordBatch.from_arrays([text_of(piece, "label"), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])

    rows = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("text", "label").mapInArrow(measure, "label int, x array<double>").toArrow()
    x = np.array(rows["x"].to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    y = rows["label"].to_numpy().astype(float)
    order = np.lexsort([*x.T, y])  # the same sums whatever the order of arrival
    return fit(x[order], y[order])


def scores(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            for piece in pieces(batch):
                found = probability(features(text_of(piece)), shared.value)
                yield pa.RecordBatch.from_arrays([text_of(piece, "doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
