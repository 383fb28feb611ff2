"""Queries against their SQL, on whole tables."""

import math
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import duckdb
import pytest

import corpus_pipeline
from dockflow.llm.language_id import BUCKETS, EVIDENCE
from dockflow.llm.queries import ORACLE, QUERIES
from tests.llm.test_brute_force import near_truth

FOLDER = "/root/testdata/sf0.001"


def as_text(frame):
    whole = lambda x: None if x != x or x is None else int(x) if isinstance(x, float) and x.is_integer() else x
    held = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(map(str, map(whole, r))) for r in held.where(held.notna(), None).values.tolist())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    assert as_text(QUERIES[name](spark, FOLDER).toPandas()) == as_text(db.sql(ORACLE[name]).df())


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, FOLDER).toPandas()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert list(rows.columns) == [*docs.columns, "epoch", "draw", "taken"]
    assert 0 < rows.doc_id.nunique() <= docs.count()
    assert not rows.duplicated(["doc_id", "epoch"]).any()
    assert len(corpus_pipeline.STAGES) == 5


@lru_cache(maxsize=None)
def bucket(gram):
    """Where a run of characters is counted."""
    x = len(gram)
    for c in gram:
        x = (x << 21) + ord(c) & (1 << 64) - 1
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> shift) * factor & (1 << 64) - 1
    return (x ^ x >> 31) % BUCKETS


def grams(text):
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return Counter(bucket(low[i : i + n]) for n in (1, 2, 3) for i in range(len(low) - n + 1))


def identified(rows):
    counts = defaultdict(Counter)
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 5 and r["lang"] is not None and r["text"] is not None:
            counts[r["lang"]].update(grams(r["text"]))
    logs = {k: [math.log((c[b] + 1) / (c.total() + BUCKETS)) for b in range(BUCKETS)] for k, c in sorted(counts.items())}
    for r in rows:
        if re.search(r"[^\W\d_]", r["text"] or ""):
            found = grams(r["text"])
            sums = [sum(n * log[b] for b, n in found.items()) * min(found.total(), EVIDENCE) / found.total() for log in logs.values()]
            if 1 / sum(math.exp(x - max(sums)) for x in sums) >= 0.5:
                yield r


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def clean(rows, items):
    windows = set()
    for text in items:
        w = benchmark_words(text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(x) for x in windows}
    for r in rows:
        w = benchmark_words(r["text"])
        if not any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1)):
            yield r


def test_pipeline_against_plain_python(spark):
    db = duckdb.connect()
    docs = db.sql(f"SELECT * FROM '{FOLDER}/documents.parquet'").df().astype(object)
    rows = docs.where(docs.notna(), None).to_dict("records")
    rows = list(identified(rows))
    last = {lowered(r["text"]): r["doc_id"] for r in sorted(rows, key=lambda r: r["doc_id"])}
    rows = [r for r in rows if last[lowered(r["text"])] == r["doc_id"]]
    near = near_truth([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if near[r["doc_id"]][2]]
    rows = list(clean(rows, [t for (t,) in db.sql(f"SELECT text FROM '{FOLDER}/benchmark.parquet'").fetchall()]))
    kept = [r["doc_id"] for r in rows]
    db.execute(f"CREATE TABLE documents AS SELECT * FROM '{FOLDER}/documents.parquet' WHERE doc_id IN ({', '.join(map(str, kept))})")
    want = db.sql(f"SELECT doc_id, epoch, draw, taken FROM ({ORACLE['op1_mixing']})").fetchall()
    found = corpus_pipeline.run(spark, FOLDER).select("doc_id", "epoch", "draw", "taken").collect()
    assert sorted(map(tuple, found)) == sorted(want)
    assert 0 < len(kept) < len(docs)
