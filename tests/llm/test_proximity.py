"""Proximity matches of benchmark passages, against brute force and on made-up edits."""

import random
import re
from collections import Counter

import pytest

from dockflow.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size, slop):
    """doc_id: items with a proximity match and no exact one."""
    texts = [(doc_id, words(text)) for doc_id, text in docs]
    df = Counter(word for _, w in texts for word in w)
    phrases = {}
    for item_id, text in items:
        w = words(text)
        for i in range(max(len(w) - size + 1, 1) if w else 0):
            phrases.setdefault(tuple(w[i : i + size]), set()).add(item_id)
    out = []
    for doc_id, w in texts:
        exact, close = set(), set()
        for phrase, ids in phrases.items():
            n, may_miss = len(phrase), 1 if len(phrase) >= 4 else 0
            if any(tuple(w[i : i + n]) == phrase for i in range(len(w) - n + 1)):
                exact |= ids
            by = sorted((df[word], o) for o, word in enumerate(phrase) if df[word])
            if len(by) < n - may_miss or not by:
                continue
            anchors = [o for _, o in by[: 2 if may_miss and len(by) == n else 1]]
            for s in {i - o for o in anchors for i, word in enumerate(w) if word == phrase[o]}:
                there = sum(phrase[o] in w[max(s + o - slop, 0) : max(s + o + slop + 1, 0)] for o in range(n))
                if there >= n - may_miss:
                    close |= ids
        out.append((doc_id, sorted(exact - {None}), sorted(close - exact - {None})))
    return sorted(out)


def found(spark, docs, items, **more):
    frame = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"), **more
    )
    return sorted((r.doc_id, r.item_ids, r.near_item_ids) for r in frame.collect())


TEN = "one two three four five six seven eight nine ten".split()
LONG = [("x", " ".join(TEN)), ("short", "alpha beta"), ("none", ""), (None, "gamma delta epsilon zeta eta")]


def test_edits(spark):
    docs = [
        (1, "so " + " ".join(TEN) + " on"),  # exact
        (2, " ".join(TEN[:4] + ["other"] + TEN[5:])),  # a word replaced
        (3, " ".join(TEN[1:])),  # the first left out, at the very start
        (4, " ".join(TEN[:5] + ["in", "between"] + TEN[5:])),  # two words put in
        (5, " ".join(TEN[:2] + ["a", "b"] + TEN[4:])),  # two replaced: no match
        (6, " ".join(TEN[:5] + ["a"] * 9 + TEN[5:])),  # too far apart
        (7, "beta alpha"),  # a short phrase, all terms within reach
        (8, "alpha"),
        (9, None),
        (10, "gamma delta epsilon zeta eta"),  # an item without id
        (11, " ".join(reversed(TEN))),
    ]
    near = {doc_id: (exact, close) for doc_id, exact, close in found(spark, docs, LONG)}
    assert near[1] == (["x"], [])
    assert [d for d in near if near[d][1] == ["x"]] == [2, 3, 4]
    assert near[7] == ([], ["short"])
    for doc_id in (5, 6, 8, 9, 10, 11):
        assert near[doc_id] == ([], [])


def test_term_that_no_document_has(spark):
    docs = [(1, " ".join(TEN[:6] + ["changed"] + TEN[7:])), (2, " ".join(TEN[:5] + ["x", "changed"] + TEN[7:]))]
    assert found(spark, docs, LONG) == [(1, [], ["x"]), (2, [], [])]


@pytest.mark.parametrize("seed,size,slop", [(1, 5, 3), (2, 6, 1), (3, 4, 2), (4, 3, 2)])
def test_brute_force(spark, seed, size, slop):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(14)]
    items = [(f"i{i}", " ".join(rng.choices(vocabulary + ["unseen"], k=rng.choice([1, 2, 3, 6, 9])))) for i in range(12)] + [(None, "w1 w2 w3 w4 w5")]
    docs = [(i // 2 if i < 6 else i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 12, 30])))) for i in range(60)]
    expected = brute(docs, items, size, slop)
    assert found(spark, docs, items, size=size, slop=slop) == expected
    assert any(close for _, _, close in expected)


def test_without_proximity_the_exact_matches_stay(spark):
    docs = [(1, " ".join(TEN)), (2, " ".join(TEN[:4] + ["other"] + TEN[5:]))]
    assert found(spark, docs, LONG, near=False) == [(1, ["x"], []), (2, [], [])]
