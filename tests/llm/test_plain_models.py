"""Learned scores, text measures and licence windows against plain Python, a text at a time."""

import math
import random
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from dockflow.llm import language_id, license_scan, quality
from dockflow.llm.textbytes import U, mix

WORDS = {"en": "the harbour lies still at night and boats rest", "de": "der Hafen liegt still über Nacht während Boote ruhen", "fr": "le port dort à l'été où les bateaux reposent"}


def texts(seed, n=60):
    """(doc_id, text, lang): clean prose, junk, repeated words and lines, and every odd text."""
    rand = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rand.choice(sorted(WORDS))
        words = [rand.choice(WORDS[lang].split()) for _ in range(rand.randint(1, 60))]
        if i % 3 == 0:
            words = [w + rand.choice(["", "!", " ##", "9", "."]) for w in words] + words[-1:] * rand.randint(1, 5)
        rows.append((i, "".join(w + rand.choice([" ", " ", "\n", "\t"]) for w in words), lang))
    return rows + [(n, None, "en"), (n + 1, "", "de"), (n + 2, " \n\t", "fr"), (n + 3, "12 34 !!", "en"), (n + 4, "Ü", None), (n + 4, "Ü", None)]


def measured(text):
    data = (text or "").encode()
    words, lines = data.split(), [x for x in data.split(b"\n") if x]
    low = [w.lower() for w in words]
    letter = [any(c >= 128 or chr(c).isalpha() for c in w) for w in words]
    mark = {c for c in range(33, 127) if not chr(c).isalnum()} - set(b".,;:")
    size, n = len(data), len(words)
    share = lambda x, of: x / max(of, 1)
    return [
        math.log1p(size), math.log1p(n), share(size, n), share(sum(65 <= c <= 90 for c in data), size), share(sum(48 <= c <= 57 for c in data), size),
        share(sum(c in b".,;:" for c in data), size), share(sum(c in mark for c in data), size), share(sum(c >= 128 for c in data), size),
        share(len(set(low)), n), share(sum(a == b for a, b in zip(low, low[1:])), n), share(n - sum(letter), n),
        share(sum(ok and w[-1] in mark for ok, w in zip(letter, words)), n), math.log1p(share(size, len(lines))),
        1 - len({x.lower() for x in lines}) / len(lines) if lines else 0.0,
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_text_measures(seed):
    rows = [t for _, t, _ in texts(seed)]
    found = quality.features(pa.array(rows, pa.string()))
    assert np.allclose(found, [measured(t) for t in rows], atol=1e-9)


def test_quality_scores(spark):
    rows = texts(3, 400)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(400)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert model["pairs"] and sum(np.abs(t).sum() for t in model["tables"]) > 0

    def plain(text):
        x = measured(text)
        bins = [bisect_right(list(cuts), v + 1e-12) for cuts, v in zip(model["cuts"], x, strict=True)]
        total = model["start"] + sum(t[b] for t, b in zip(model["tables"], bins, strict=True))
        return 1 / (1 + math.exp(-total - sum(t[bins[i], bins[j]] for i, j, t in model["pairs"])))

    want = sorted((i, plain(t)) for i, t, _ in rows)
    found = sorted((r.doc_id, r.score) for r in quality.scores(docs, model).collect())
    assert [i for i, _ in found] == [i for i, _ in want]
    assert np.mean(np.abs(np.array([s for _, s in found]) - [s for _, s in want]) < 1e-6) > 0.98  # values on a cut may fall to either side
    assert all(r.score == 0.5 for r in quality.scores(docs, quality.train(docs, labels.limit(0))).collect())


def test_language_scores(spark):
    rows = texts(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    buckets = 512

    def grams(text):
        low = text.lower()
        for n in language_id.ORDERS:
            for i in range(len(low) - n + 1):
                code = n
                for c in low[i : i + n]:
                    code = ((code << 21) + ord(c)) & (2**64 - 1)
                yield int(mix(np.array([code], dtype=U))[0]) % buckets

    counts = {k: Counter() for k in WORDS}
    for _, text, lang in rows:
        if text is not None and lang:
            counts[lang].update(grams(text))
    logp = {k: [math.log((c[b] + 1) / (c.total() + buckets)) for b in range(buckets)] for k, c in counts.items()}

    def plain(text):
        if not re.search(r"[^\W\d_]", text or ""):
            return "und", 0.0
        own = list(grams(text))
        total = {k: sum(logp[k][b] for b in own) * min(len(own), language_id.EVIDENCE) / len(own) for k in sorted(logp)}
        best = max(total, key=total.get)
        return best, 1 / sum(math.exp(v - total[best]) for v in total.values())

    found = sorted((r.doc_id, r.lang_pred, r.score) for r in language_id.languages(docs, language_id.train(docs, buckets)).collect())
    for (i, lang, score), (j, text, _) in zip(found, rows, strict=True):
        want = plain(text)
        assert (i, lang) == (j, want[0]) and score == pytest.approx(want[1], abs=1e-4)


@pytest.mark.parametrize("seed", range(40))
def test_licence_windows(seed):
    """Every window of a template's longest length or less, by force."""
    rand, least = random.Random(seed), 0.75
    vocabulary = [f"w{i}" for i in range(rand.choice([6, 12, 30]))]
    some = lambda n: [rand.choice(vocabulary) for _ in range(n)]
    templates = {k: some(rand.randint(3, 9)) for k in "abc"}
    text = some(10)
    for k in rand.choices("abc", k=3):
        own = list(templates[k])
        own[rand.randrange(len(own))] = rand.choice(vocabulary)
        text += [*rand.choice([own, templates[k]]), *some(rand.randint(0, 6))]
    joined = "".join(w + rand.choice([" ", "\n", ", ", "\n\n# "]) for w in text)

    pair = list(zip(text, text[1:]))
    line = [joined.count("\n", 0, m.start()) + 1 for m in re.finditer(r"\w+", joined)]
    found = []
    for k, words in sorted(templates.items()):
        own = set(zip(words, words[1:]))
        for i in (i for i, p in enumerate(pair) if p in own):
            ends = [j for j in range(i, min(i + int(len(own) * (2 - least) / least), len(pair))) if pair[j] in own]
            dice = {j: 2 * len(own & set(pair[i : j + 1])) / (len(own) + len(set(pair[i : j + 1]))) for j in ends}
            j = max(ends, key=lambda j: (dice[j], -j))
            if dice[j] >= least:
                found.append((-len(own & set(pair[i : j + 1])), -dice[j], "abc".index(k), i, j))
    want, taken = [], set()
    for _, d, k, i, j in sorted(found):
        if not taken & set(range(i, j + 1)):
            taken |= set(range(i, j + 1))
            want.append((0, line[i], line[j + 1], k, -d))
    known = license_scan.compile_templates({k: " ".join(w) for k, w in templates.items()})
    assert license_scan.windows(pa.array([joined]), known, least) == want
