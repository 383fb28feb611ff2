"""Sharding, fill-in-the-middle and prefix tries against SQL and plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.llm import fill_middle, prefix_trie, sharding
from dockflow.llm.queries import ORACLE

FOLDER = "/root/testdata/sf0.01"


def cells(rows):
    return sorted(tuple(map(str, r)) for r in rows)


# Sharding


def by_hand(rows, shards=8):
    """(doc_id, text) -> (doc_id, size, crc, shard, slot), one row after the other."""
    rows = [(i, t or "") for i, t in rows]
    key = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    sized = sorted((key(t), -(1 << 63) if i is None else i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows)
    due = max(1, -(-sum(s[2] for s in sized) // shards))
    held, n = Counter(), Counter()
    for k, _, size, _ in sized:
        held[k] += size
        n[k] += 1
    at, first, slots, out = 0, {}, Counter(), []
    for k, i, size, crc in sized:
        first.setdefault(k, at)
        cut = held[k] > due * sharding.TOGETHER or n[k] > max(1.0, len(rows) / shards * sharding.TOGETHER)
        shard = ((at + size // 2) if cut else first[k] + held[k] // 2) // due
        out.append((None if i == -(1 << 63) else i, size, crc, shard, slots[shard]))
        slots[shard] += 1
        at += size
    return out


def shares(rows):
    return rows.select("doc_id", "size", "text_crc32", "shard", "slot").collect()


@pytest.mark.parametrize("hot", [0, 400])
def test_shards_by_hand(spark, hot):
    rng = random.Random(hot)
    rows = [(i, " ".join(rng.choices("abc def ghi".split(), k=rng.choice([0, 1, 9, 60])))) for i in range(800)]
    rows += [(1000 + i, "the same text over and over") for i in range(hot)] + [(5000, "x" * 9000), (None, None), (None, ""), (7, None), (7, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for range_bytes in (1 << 30, 64):
        assert cells(shares(sharding.shard(frame, range_bytes=range_bytes))) == cells(by_hand(rows))


def test_copies_stay_together_and_sizes_are_even(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    placed = sharding.shard(docs)
    rows = placed.groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("slot").alias("s"), F.countDistinct("slot").alias("d")).collect()
    mean = sum(r.b for r in rows) / 8
    assert len(rows) == 8 and all(abs(r.b - mean) < 0.04 * mean and r.s == r.n - 1 and r.d == r.n for r in rows)
    assert placed.groupBy("key").agg(F.countDistinct("shard").alias("n")).where("n > 1").isEmpty()
    most = placed.groupBy("cell").count().agg(F.max("count")).first()[0]
    assert most < 10_000 / 256 * 4  # ranges deal the rows out evenly


def test_a_row_hot_key_is_spread_over_ranges(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "").otherwise(F.concat(F.lit("text number "), "id")).alias("text"))
    per = sharding.shard(rows).groupBy("cell").count().agg(F.max("count")).first()[0]
    assert per < 20_000 / 256 * 8


def test_write_shards(spark, odd, none, tmp_path):
    sharding.write_shards(odd.withColumn("shard", F.lit("mine")), f"{tmp_path}/out", 3)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == odd.count() and {"own_shard", "slot", "shard"} < set(back.columns)
    text = lambda d: sorted(str((r.doc_id, r.text)) for r in d.collect())
    assert text(back) == text(odd)
    assert sharding.shard(none).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(odd, 0)


def test_odd_rows_have_shards(odd):
    rows = sharding.shard(odd).collect()
    assert len(rows) == odd.count() and {r.shard for r in rows} <= set(range(8))
    assert cells((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in rows) == cells(by_hand([(r.doc_id, r.text) for r in odd.collect()]))


# Fill in the middle


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 100, 5000])
def test_lanes_reach_every_rank(n):
    widths = np.random.default_rng(n).integers(1, 9, n)
    lanes = fill_middle.Lanes(widths)
    total = np.concatenate([[0], np.cumsum(widths)])
    assert [lanes.reach(r) for r in range(n + 1)] == total.tolist()
    with pytest.raises(IndexError):
        lanes.reach(n + 1)
    assert all(u.sum() == n and p.sum() == widths.sum() for u, p, _ in lanes.lanes)


def test_cut_by_hand():
    texts = ["", "a", "déjà vu 🙂 — ok", "has <S> in it", "<M", "<P" * 9, "S>" + "<" * 30, "long " * 5000]
    forms = set()
    for doc_id in [None, *range(300)]:
        text = texts[(doc_id or 0) % len(texts)]
        n, form, a, m, output = fill_middle.transform(doc_id, text)
        h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
        low, high = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
        plain = not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90
        forms.add(form)
        if plain:
            assert (n, form, a, m, output) == (len(text), "plain", None, None, text)
        else:
            p, mid, s = text[:low], text[low:high], text[high:]
            want = f"<S>{s}<P>{p}<M>{mid}" if h[3] % 100 < 20 else f"<P>{p}<S>{s}<M>{mid}"
            assert (n, a, m, output) == (len(text), low, high - low, want)
        assert fill_middle.restore(output, form) == text
    assert forms == {"plain", "psm", "spm"}


def test_words_as_units():
    text = "one  two three\nfour " * 50
    n, form, a, m, output = fill_middle.transform(1, text, r"\S+\s*")
    assert n == 200 and fill_middle.restore(output, form) == text
    ends = {x.end() for x in re.finditer(r"\S+\s*", text)} | {0}
    assert form == "plain" or {a, a + m} <= ends
    with pytest.raises(ValueError):
        fill_middle.transform(1, " " + text, r"\S+\s*")


def test_odd_rows_are_cut(odd, none):
    rows = fill_middle.restored(fill_middle.fill_in_middle(odd)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.restored) for r in rows), key=key) == sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=key)
    assert fill_middle.fill_in_middle(none).count() == 0


# Prefix tries


def nodes_in_sql(rows):
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    names = "conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256"
    return db.sql(f"SELECT {names} FROM ({ORACLE['op13_prefix_trie']})").fetchall()


def nodes(spark, rows, **how):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).withColumn("shard", F.lit("x")).withColumn("length", F.lit(2))
    return prefix_trie.prefix_nodes(*prefix_trie.shared_openings(prefix_trie.numbered(frame)), **how).collect()


SMALL = {"segment": 3, "shard_turns": 7, "hot_turns": 4}


def made(kind):
    rng = random.Random(kind)
    talk = lambda c, n, words: [(c, i, "user" if i % 2 == 0 else "bot", rng.choice(words)) for i in range(n)]
    if kind == "alike":  # few different turns: deep sharing, equal conversations, hot prefixes at every depth
        return [r for c in range(120) for r in talk(c, rng.randint(1, 9), ["hi", "hi", "hi", "yes", "nó 🙂"])]
    if kind == "one":  # one conversation holds most rows, copies of another, and the bases are missing
        rows = talk(111, 90, ["a", "b"]) + [(c, i, "user", f"same {i}") for c in range(130, 160) for i in range(7)]
        return rows + [(c, i, "user", f"same {i}") for c in range(700, 705) for i in range(c - 698)]
    odd = [(None, 0, "user", "lost"), (5, None, None, None), (5, None, "user", None), (5, 1, "user", "x"), (5, 1, "user", "x"), (0, 3, "", ""), (0, 2, "user", "x"), (-3, 0, "user", "x"), (7, 0, "user", "x" * 70_000)]
    return odd + [(c, 0, "user", "") for c in range(20, 40)]


@pytest.mark.parametrize("kind", ["alike", "one", "odd"])
@pytest.mark.parametrize("how", [{}, SMALL])
def test_nodes_by_sql(spark, kind, how):
    rows = made(kind)
    assert cells(nodes(spark, rows, **how)) == cells(nodes_in_sql(rows))


def test_no_conversations(spark):
    assert nodes(spark, []) == [] == nodes_in_sql([])
    assert nodes(spark, [(None, 1, "user", "x")]) == []


def test_double_array():
    rng = random.Random(3)
    trie, known = prefix_trie.DoubleArray(4), {}
    states = [0]
    for _ in range(40):
        pairs = sorted({(s, rng.randrange(500)) for s in states for _ in range(rng.choice([1, 1, 1, 6]))})
        state, symbol = (np.array(x) for x in zip(*pairs, strict=True))
        trie.add(state, symbol)
        slots = trie.child(state, symbol)
        assert (slots > 0).all() and not set(slots.tolist()) & set(known.values()) and len(set(slots.tolist())) == len(pairs)
        known |= dict(zip(pairs, slots.tolist(), strict=True))
        states = rng.sample(slots.tolist(), min(len(slots), 30))
    every = defaultdict(set)
    for s, c in known:
        every[s].add(c)
    for s, own in every.items():
        symbols = np.arange(500)
        assert set(symbols[trie.child(np.full(500, s), symbols) >= 0].tolist()) == own
    assert all(trie.child(np.array([s]), np.array([c]))[0] == slot for (s, c), slot in known.items())
