"""Language by multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams (1 to 3 lower-cased characters, hashed to `buckets`) of every labelled
text: a task sums its counts per language and sends them once, whatever its number of rows. The
log-probability matrix, languages x buckets, is bounded by its two sizes and broadcast. Scoring
adds the looked-up values of a batch with numpy.

A text without a letter, a null or an empty one is `und` with score 0. So is every text when
nothing was learned. Ties between languages go to the first in order. The score is the posterior
probability of the language at `evidence` n-grams, so that it doesn't run to 0 or 1 with length.
Repeated rows score alike; columns other than doc_id and text (and lang in training) are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import pieces
from dockflow.llm.textbytes import U, mix, text_of

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
EVIDENCE = 60
MOST_LANGUAGES = 500


def ngrams(texts: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: buckets of all n-grams, and the text that each is in."""
    low = pc.utf8_lower(pc.fill_null(texts, ""))
    sizes = pc.utf8_length(low).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(low.to_pylist()).encode("utf-32-le"), dtype=np.uint32).astype(U)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    for n in ORDERS:
        if len(points) < n:
            continue
        code = np.full(len(points) - n + 1, n, dtype=U)
        for j in range(n):
            code = (code << U(21)) + points[j : len(points) - n + 1 + j]
        whole = owner[: len(code)] == owner[n - 1 :]
        yield (mix(code[whole]) % U(buckets)).astype(np.int64), owner[: len(code)][whole]


def has_letter(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def train(docs: DataFrame, buckets: int = BUCKETS) -> dict:
    """The model from columns text and lang of all given rows with a language."""

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in pieces(batch):
                coded = pc.dictionary_encode(text_of(piece, "lang"))
                codes, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
                part = np.zeros(len(names) * buckets, dtype=np.int64)
                for found, owner in ngrams(text_of(piece), buckets):
                    part += np.bincount(codes[owner] * buckets + found, minlength=len(part))
                for name, own in zip(names, part.reshape(-1, buckets), strict=True):
                    sums[name] = sums[name] + own if name in sums else own
        for name, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["lang", "bucket", "n"])

    counts = (
        docs.where("lang is not null and text is not null").select("text", "lang")
        .mapInArrow(count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    per_language = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
    rows = per_language.limit(MOST_LANGUAGES + 1).collect()  # bounded: languages x buckets
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: is `lang` a language?")
    names = sorted(r.lang for r in rows)
    matrix = np.ones((len(names), buckets))
    for r in rows:
        at = np.array([x.bucket for x in r.counts], dtype=np.int64)
        matrix[names.index(r.lang), at] += np.array([x.n for x in r.counts], dtype=float)
    return {"languages": names, "logp": np.log(matrix / matrix.sum(axis=1, keepdims=True)).astype(np.float32)}


def predict(texts: pa.Array, model: dict) -> tuple[list[str], np.ndarray]:
    names, logp = model["languages"], model["logp"]
    n = len(texts)
    if not names:
        return ["und"] * n, np.zeros(n)
    total, seen = np.zeros((len(names), n)), np.zeros(n)
    for found, owner in ngrams(texts, logp.shape[1]):
        seen += np.bincount(owner, minlength=n)
        for k in range(len(names)):
            total[k] += np.bincount(owner, weights=logp[k][found], minlength=n)
    best = total.argmax(axis=0)
    mean = total * (np.minimum(seen, EVIDENCE) / np.maximum(seen, 1))
    share = np.exp(mean - mean.max(axis=0))
    known = has_letter(texts)
    return [names[k] if ok else "und" for k, ok in zip(best, known, strict=True)], np.where(known, share.max(axis=0) / share.sum(axis=0), 0.0)


def languages(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            for piece in pieces(batch):
                names, scores = predict(text_of(piece), shared.value)
                yield pa.RecordBatch.from_arrays([text_of(piece, "doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """The documents with a language and a score of `least` or more; all columns, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        for batch in batches:
            for piece in pieces(batch):
                names, scores = predict(text_of(piece), shared.value)
                yield piece.filter(pa.array(np.array([x != "und" for x in names], dtype=bool) & (scores >= least)))

    return docs.mapInArrow(keep, docs.schema)
