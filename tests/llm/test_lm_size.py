"""What grows with the collection: the vocabulary stays off the driver, and finer ranges don't write more."""

import math
from collections import Counter

import numpy as np
import pytest

from dockflow.llm import lm_score

WORDS, DOCS = 100, 3000


@pytest.fixture(scope="module")
def texts():
    """A few common words, many rare ones, repeated and empty rows."""
    chosen = np.random.default_rng(7).zipf(1.3, (DOCS, WORDS)) % 200_003
    made = [(i, " ".join(f"w{x}" for x in row)) for i, row in enumerate(chosen.tolist())]
    return [*made, made[0], (None, made[1][1]), (DOCS, ""), (DOCS + 1, None), (DOCS + 2, "alone")]


@pytest.fixture(scope="module")
def frame(spark, texts):
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(4).localCheckpoint()


def by_hand(texts, least=lm_score.LEAST):
    words = [(i, (text or "").split()) for i, text in texts]
    one, two = Counter(x for _, w in words for x in w), Counter(p for _, w in words for p in zip(w, w[1:], strict=False))
    total = sum(one.values())
    seen = lambda v, w: math.log(two[v, w] / one[v]) if two[v, w] >= least else math.log(lm_score.ALPHA * one[w] / total)
    score = lambda w: sum(seen(*p) for p in zip(w, w[1:], strict=False)) + math.log(one[w[0]] / total) if w else 0.0
    return sorted((i is None, i or 0, len(w), round(score(w), 6)) for i, w in words)


def rows(found):
    return sorted((x.doc_id is None, x.doc_id or 0, x.n_words, round(x.log_score, 6)) for x in found.collect())


def same(found, texts):
    got, want = rows(found), by_hand(texts)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert [x[3] for x in got] == pytest.approx([x[3] for x in want], abs=1e-5)


def exchanged(frame) -> int:
    """Bytes that the exchanges of a collected frame have written."""

    def of(node) -> int:
        kind = node.getClass().getSimpleName()
        if kind == "ReusedExchangeExec":
            return 0
        if kind == "AdaptiveSparkPlanExec":
            return of(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return of(node.plan())
        below = node.children()
        own = node.metrics().get("shuffleBytesWritten").get().value() if kind == "ShuffleExchangeExec" else 0
        return own + sum(of(below.apply(i)) for i in range(below.size()))

    return of(frame._jdf.queryExecution().executedPlan())


def test_vocabulary_stays_off_the_driver(frame, texts, monkeypatch):
    def refuse(self):
        raise AssertionError("a table goes to the driver")

    monkeypatch.setattr(type(frame), "toArrow", refuse)
    same(lm_score.scores(frame), texts)


def test_ranges_dont_add_to_what_is_written(frame, texts, monkeypatch):
    bytes_written = []
    for words in (lm_score.RANGE_WORDS, WORDS * DOCS // 100):
        monkeypatch.setattr(lm_score, "RANGE_WORDS", words)
        found = lm_score.scores(frame)
        same(found, texts)
        bytes_written.append(exchanged(found))
    one, hundred = bytes_written
    assert hundred < 1.4 * one and hundred < 10 * WORDS * DOCS


@pytest.mark.parametrize("block", [1, 150, 50_000])
def test_blocks_of_any_size(frame, texts, monkeypatch, block):
    monkeypatch.setattr(lm_score, "BLOCK_WORDS", block)
    monkeypatch.setattr(lm_score, "RANGE_WORDS", 20_000)
    same(lm_score.scores(frame), texts)
