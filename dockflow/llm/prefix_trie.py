"""The prefix tree of conversations, its counts, and the text that sharing prefixes saves.

A node is a distinct sequence of first turns (role, text); the root has none. Turns are ordered by
`turn`, null first; turns of one number by a digest of role and text. A null role or text is empty.
Rows without a conv_id belong to no conversation and are left out; repeated rows are turns of their
own. No conversations: no nodes, not even a root. Only conv_id, turn, role and text are read; the
texts leave the first stage as two 60-bit parts of their MD5 and a length.

Conversations are paths of turn digests, in pieces of at most `SEGMENT` turns, so a conversation of
any length is dealt over rows. Equal pieces are folded into one row with a weight before anything
else. Pieces go to prefix shards by their first turn; where more than `HOT_TURNS` turns (or a
thousandth of all) begin alike, by their first 2, 4, 8, … turns. A shard packs its pieces into one
double array: the child of state s by dense turn id c is the slot BASE[s] + c if CHECK of that slot
is s. Walking the pieces through it gives the shard's nodes with members, smallest member, children,
and subtree sums from the deepest level up.

Some upper nodes are not one shard's: the root, those above a longer cut, and those of a conversation
that goes on in a further piece. Shards give partial aggregates for them; these are merged by
prefix digest, and their subtree sums added up by doubling: round k adds to each node the sums of the nodes
2^k below it, so a chain of any length takes as many rounds as its length has bits. The other nodes
are final when they leave their shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.llm.common import written
from dockflow.llm.textbytes import text_of

SEGMENT, SHARD_TURNS, HOT_TURNS = 1024, 200_000, 100_000
#: Places tried for the children of a state before the array grows.
TRIES = 64
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = "shared boolean, depth long, d1 long, d2 long, p1 long, p2 long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, points long"
KEY = ["depth", "d1", "d2"]


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, i (1, 2, … in a conversation), digest of role and text in two numbers, code points."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role), F.lit(":"), role, text).cast("binary"))
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    slim = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), part(1).alias("t1"), part(16).alias("t2"), F.length(text).cast("long").alias("points")
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "t1", "t2")
    return slim.withColumn("i", F.row_number().over(order).cast("long")).drop("turn")


def shared_openings(turns: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Every conversation c again, with the first crc32(c) % `most` turns of the first conversation
    of its block (fewer if that has fewer, none if it is absent) in place of as many of its own.
    Returns (conv_id, length) of all, and the turns: conv_id, length, pos (from 1), t1, t2, points."""
    turns = written(turns, "turns")
    first = F.col("conv_id") - F.col("conv_id") % block
    heads = turns.where((first == F.col("conv_id")) & (F.col("i") < most)).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("i", "t1", "t2", "points"))).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    convs = turns.groupBy("conv_id").agg(F.max("i").alias("own")).withColumn("h", h).withColumn("base", first)
    convs = convs.join(heads, "base", "left").withColumn("head", F.when(F.col("head").isNull() | (F.col("h") == 0), F.slice("head", 1, 0)).otherwise(F.slice("head", 1, F.col("h"))))
    convs = convs.withColumn("n_head", F.coalesce(F.size("head"), F.lit(0))).withColumn("n_head", F.greatest("n_head", F.lit(0)))
    convs = written(convs.select("conv_id", "h", "head", "n_head", (F.col("n_head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "rebuilt")
    begin = convs.select("conv_id", "length", F.explode("head").alias("x")).select("conv_id", "length", F.col("x.i").alias("pos"), "x.t1", "x.t2", "x.points")
    rest = turns.join(convs.drop("head"), "conv_id").where("i > h").select("conv_id", "length", (F.col("n_head") + F.col("i") - F.col("h")).alias("pos"), "t1", "t2", "points")
    return convs.select("conv_id", "length"), begin.unionByName(rest)


def _long(total: Column) -> Column:
    """A whole number modulo 2**64, as a long."""
    size = F.lit(Decimal(1 << 64))
    rest = F.pmod(total, size)
    return F.when(rest >= F.lit(Decimal(1 << 63)), rest - size).otherwise(rest).cast("long")


def _pieces(turns: DataFrame, segment: int) -> DataFrame:
    """conv_id, length, piece, path, and the prefix digests before (r1, r2) and after it (e1, e2).
    A prefix digest is the sum of the hashes of (position, turn): two sums modulo 2**64."""
    lanes = turns.select(
        "conv_id", "length", F.expr(f"(pos - 1) div {segment}").alias("piece"),
        F.struct("pos", F.xxhash64("t1", "t2", "pos").alias("g1"), F.xxhash64("pos", "t2", "t1").alias("g2"), "points").alias("turn"),
    )
    total = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    cut = lanes.groupBy("conv_id", "piece").agg(F.max("length").alias("length"), total("turn.g1").alias("s1"), total("turn.g2").alias("s2"), F.array_sort(F.collect_list("turn")).alias("path"))
    cut = written(cut, "pieces")
    zero = F.lit(0).cast("long")
    short = cut.where(f"length <= {segment}").select("conv_id", "length", "piece", "path", zero.alias("r1"), zero.alias("r2"), _long(F.col("s1")).alias("e1"), _long(F.col("s2")).alias("e2"))
    long = cut.where(f"length > {segment}")
    upto = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)
    sums = long.select("conv_id", "piece", "s1", "s2", F.sum("s1").over(upto).alias("u1"), F.sum("s2").over(upto).alias("u2"))
    sums = sums.select("conv_id", "piece", *(_long(F.col(u) - F.col(s)).alias(r) for u, s, r in (("u1", "s1", "r1"), ("u2", "s2", "r2"))), _long(F.col("u1")).alias("e1"), _long(F.col("u2")).alias("e2"))
    return short.unionByName(long.join(sums, ["conv_id", "piece"]).select(*short.columns))


def _sharded(folded: DataFrame, segment: int, shard_turns: int, hot_turns: int) -> DataFrame:
    """The pieces with `shard` and `cut`, the number of first turns that decide the shard."""
    total = folded.agg(F.coalesce(F.sum(F.size("path")), F.lit(0))).first()[0]
    most = max(hot_turns, total // 1000)  # so at most 1000 prefixes are hot
    key = lambda n: F.xxhash64("piece", "r1", "r2", F.slice("path", F.lit(1), n))
    rows = folded.withColumn("cut", F.lit(1)).withColumn("prefix", key(F.lit(1)))
    n = 1
    while n < segment:
        hot = rows.where(F.col("cut") == n).groupBy("prefix").agg(F.sum(F.size("path")).alias("turns"), F.count(F.lit(1)).alias("n"))
        hot = written(hot.where((F.col("turns") > most) & (F.col("n") > 1)).select("prefix", F.lit(True).alias("hot")), "hot_prefixes")
        if hot.isEmpty():
            break
        deeper = F.coalesce("hot", F.lit(False)) & (F.col("cut") == n)
        rows = rows.join(F.broadcast(hot), "prefix", "left").withColumn("cut", F.when(deeper, F.lit(2 * n)).otherwise(F.col("cut")))
        rows = rows.withColumn("prefix", F.when(deeper, key(F.lit(2 * n))).otherwise(F.col("prefix"))).drop("hot")
        n *= 2
    return rows.withColumn("shard", F.pmod("prefix", F.lit(max(1, -(-total // shard_turns)))))


def _dense(*columns: np.ndarray) -> np.ndarray:
    """Numbers from 0 for distinct rows."""
    out = np.unique(columns[0], return_inverse=True)[1].astype(np.int64)
    for c in columns[1:]:
        own = np.unique(c, return_inverse=True)[1]
        out = np.unique(out * (int(own.max(initial=0)) + 1) + own, return_inverse=True)[1]
    return out


class DoubleArray:
    """States are slots, 0 the root; the child of s by symbol c is slot base[s] + c if its check is s."""

    def __init__(self, room: int):
        self.base = np.zeros(room, dtype=np.int64)
        self.check = np.full(room, -1, dtype=np.int64)
        self.check[0] = 0
        self.free = self.top = 1  # no slot below free is free, none from top on is taken

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int64)])

    def _free_slots(self, n: int) -> np.ndarray:
        """The first n free slots."""
        found = np.flatnonzero(self.check[self.free :] < 0)
        if len(found) < n:
            self._grow(len(self.check) + n)
            found = np.flatnonzero(self.check[self.free :] < 0)
        return found[:n] + self.free

    def _place(self, symbols: np.ndarray) -> int:
        """A base at which the slots of all symbols are free."""
        span = int(symbols[-1] - symbols[0]) + 1
        self._grow(self.top + span + TRIES)
        for slot in self._free_slots(TRIES):
            want = slot - symbols[0] + symbols
            self._grow(int(want[-1]) + 1)
            if (self.check[want] < 0).all():
                return int(slot - symbols[0])
        return self.top - int(symbols[0])

    def add(self, state: np.ndarray, symbol: np.ndarray) -> None:
        """Children of states that have none yet, as distinct pairs sorted by state and symbol."""
        first = np.flatnonzero(np.concatenate([[True], state[1:] != state[:-1]]))
        size = np.diff(np.append(first, len(state)))
        for a, n in zip(first[size > 1], size[size > 1], strict=True):
            own = symbol[a : a + n]
            base = self._place(own)
            self._grow(base + int(own[-1]) + 1)
            self.base[state[a]] = base
            self.check[base + own] = state[a]
            self.top = max(self.top, base + int(own[-1]) + 1)
        alone = first[size == 1]
        slots = self._free_slots(len(alone))
        self.base[state[alone]] = slots - symbol[alone]
        self.check[slots] = state[alone]
        self.top = max(self.top, int(slots.max(initial=0)) + 1)
        used = np.flatnonzero(self.check[self.free :] < 0)
        self.free += int(used[0]) if len(used) else len(self.check) - self.free

    def child(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The slots of the children, -1 where there is none."""
        slot = self.base[state] + symbol
        inside = (slot > 0) & (slot < len(self.check))
        return np.where(inside & (self.check[np.where(inside, slot, 0)] == state), slot, -1)


def _trie(segment: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        column = lambda name, kind=np.int64: table.column(name).to_numpy().astype(kind)
        paths = table.column("path").chunk(0)
        size = np.diff(paths.offsets.to_numpy()).astype(np.int64)
        turns = paths.flatten()
        g1, g2, points = (turns.field(k).to_numpy().astype(np.int64) for k in ("g1", "g2", "points"))
        piece, r1, r2, cut, weight, least, goes_on = (column(k) for k in ("piece", "r1", "r2", "cut", "n", "least", "goes_on"))
        begin = np.cumsum(size) - size

        turn = _dense(g1, g2)
        symbol = np.full(int(turn.max(initial=-1)) + 1, -1, dtype=np.int64)
        start = _dense(piece, r1, r2)
        trie = DoubleArray(2 * (len(turn) + len(start)) + 16)
        root_symbols = np.unique(start)
        trie.add(np.zeros(len(root_symbols), dtype=np.int64), root_symbols)
        state = trie.child(np.zeros(len(start), dtype=np.int64), start)
        roots = state.copy()
        on = np.flatnonzero(size > 0)
        level = known = 0
        while len(on):
            # A turn is a symbol of one depth. Numbered in the order of their states, the children of a state
            # are close together, and so are their slots.
            own = turn[begin[on] + level]
            by_state = own[np.lexsort((own, state[on]))]
            met, at = np.unique(by_state, return_index=True)
            symbol[met[np.argsort(at)]] = known + np.arange(len(met))
            known += len(met)
            pairs = np.unique(np.column_stack([state[on], symbol[own]]), axis=0)
            trie.add(pairs[:, 0], pairs[:, 1])
            state[on] = trie.child(state[on], symbol[own])
            level += 1
            on = on[size[on] > level]

        # The walk: every piece through the arrays, its nodes' aggregates on the way.
        room = len(trie.check)
        zeros = lambda kind=np.int64: np.zeros(room, dtype=kind)
        n, depth, text, leaves, saved, children = (zeros() for _ in range(6))
        shared, used = zeros(bool), zeros(bool)
        conv = np.full(room, np.iinfo(np.int64).max)
        d1, d2 = zeros(np.uint64), zeros(np.uint64)
        state = roots
        used[state] = shared[state] = True
        depth[state] = piece * segment
        sum1, sum2 = r1.view(np.uint64).copy(), r2.view(np.uint64).copy()
        d1[state], d2[state] = sum1, sum2
        levels = [np.unique(state)]
        on = np.flatnonzero(size > 0)
        state = state.copy()
        for k in range(level):
            at = begin[on] + k
            slot = trie.child(state[on], symbol[turn[at]])
            state[on] = slot
            sum1[on] += g1[at].view(np.uint64)
            sum2[on] += g2[at].view(np.uint64)
            np.add.at(n, slot, weight[on])
            np.minimum.at(conv, slot, least[on])
            used[slot] = True
            shared[slot[(k + 1 < cut[on]) | (goes_on[on] > 0)]] = True
            depth[slot], text[slot], d1[slot], d2[slot] = piece[on] * segment + k + 1, points[at], sum1[on], sum2[on]
            levels.append(np.unique(slot))
            on = on[size[on] > k + 1]

        parent = np.maximum(trie.check, 0)
        saved[used] = ((n - 1) * text)[used]
        for nodes in reversed(levels[1:]):
            own = nodes[~shared[nodes]]
            leaves[own[children[own] == 0]] = 1
            np.add.at(children, parent[own], 1)
            np.add.at(leaves, parent[own], leaves[own])
            up = own[~shared[parent[own]]]
            np.add.at(saved, parent[up], saved[up])
        below = zeros()
        tops = np.flatnonzero(used & ~shared)
        tops = tops[shared[parent[tops]]]
        np.add.at(below, parent[tops], saved[tops])
        slots = np.concatenate(levels)
        is_root = np.isin(slots, levels[0])
        up = parent[slots]
        own = shared[slots]
        no_parent = is_root
        known = ~own & ~shared[up]
        values = (
            pa.array(own), pa.array(depth[slots]), pa.array(d1[slots].view(np.int64)), pa.array(d2[slots].view(np.int64)),
            pa.array(d1[up].view(np.int64), mask=no_parent), pa.array(d2[up].view(np.int64), mask=no_parent),
            pa.array(conv[slots], mask=is_root), pa.array(conv[up], mask=~known), pa.array(n[slots]), pa.array(children[slots]), pa.array(leaves[slots]),
            pa.array(np.where(own, below[slots], saved[slots])), pa.array(text[slots]),
        )
        return pa.Table.from_arrays(list(values), names=[x.split()[0] for x in NODE.split(", ")])

    return run


def _summed_up(upper: DataFrame, deepest: int) -> DataFrame:
    """The nodes with n_leaves and saved added up over their subtrees, by doubling."""
    now = upper.withColumn("j1", F.col("p1")).withColumn("j2", F.col("p2"))
    step = 1
    while step <= deepest:
        far = now.where("j1 IS NOT NULL")
        add = far.groupBy((F.col("depth") - step).alias("depth"), F.col("j1").alias("d1"), F.col("j2").alias("d2")).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        hop = now.select((F.col("depth") + step).alias("depth"), F.col("d1").alias("j1"), F.col("d2").alias("j2"), F.col("j1").alias("h1"), F.col("j2").alias("h2"))
        now = now.join(add, KEY, "left").join(hop, ["depth", "j1", "j2"], "left")
        grown = [(F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("n_leaves", "more_leaves"), ("saved", "more_saved"))]
        now = written(now.select(*(c for c in upper.columns if c not in ("n_leaves", "saved")), *grown, F.col("h1").alias("j1"), F.col("h2").alias("j2")), "doubled")
        step *= 2
    return now


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and conv_id: one digest for each node, fed as the rows come."""
    key, digest = None, None
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    names = [*KEY, "ends_sha256"]
    for batch in batches:
        done = []
        columns = [text_of(batch, k).to_numpy() for k in KEY]
        convs = text_of(batch, "conv_id")
        edge = np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)])) if len(batch) else []
        for a, b in zip(edge, [*edge[1:], len(batch)], strict=True):
            own = tuple(int(c[a]) for c in columns)
            ids = ",".join(map(str, convs.slice(a, b - a).to_pylist())).encode()
            if own == key:
                digest.update(b"," + ids)
                continue
            if key is not None:
                done.append((*key, digest.hexdigest()))
            key, digest = own, hashlib.sha256(ids)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((*key, digest.hexdigest()), kinds, strict=True)], names)


def prefix_nodes(convs: DataFrame, turns: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS, hot_turns: int = HOT_TURNS) -> DataFrame:
    """The nodes of the tree over conversations (conv_id, length) and their turns (conv_id, length,
    pos, t1, t2, points): conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved (of the subtree), and ends_sha256 of the members that end there."""
    n_all, least = convs.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    pieces = written(_pieces(turns, segment).withColumn("goes_on", (F.col("length") > (F.col("piece") + 1) * segment).cast("int")), "keyed_pieces")
    group = ["piece", "r1", "r2", "e1", "e2", F.size("path").alias("n_turns")]
    folded = pieces.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.max("goes_on").alias("goes_on"), F.first("path").alias("path"))
    rows = _sharded(written(folded, "folded"), segment, shard_turns, hot_turns)
    found = written(rows.groupBy("shard").applyInArrow(_trie(segment), NODE), "nodes")

    zero = F.lit(0).cast("long")
    root = convs.groupBy().agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        F.lit(True).alias("shared"), *(zero.alias(k) for k in KEY), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"),
        "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", *(zero.alias(k) for k in ("n_children", "n_leaves", "saved", "points")),
    )
    parts = found.where("shared").unionByName(root)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    upper = written(parts.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.max("points").alias("points"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), *sums), "upper")
    shared_children = upper.where("p1 IS NOT NULL").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(F.count(F.lit(1)).alias("more"))
    upper = upper.join(shared_children, KEY, "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
    upper = upper.withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("points")).withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long"))
    upper = written(upper, "upper")
    upper = _summed_up(upper, upper.agg(F.coalesce(F.max("depth"), zero)).first()[0])

    nodes = found.where("NOT shared").unionByName(upper.select(*found.columns[1:6], "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), *found.columns[8:]), allowMissingColumns=True)
    above = upper.where("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("above"))
    open_ = (F.col("parent_conv_id").isNull()) & (F.col("depth") > 1)
    joined = nodes.where(open_).join(above, ["depth", "p1", "p2"], "left").withColumn("parent_conv_id", F.col("above")).drop("above")
    first = F.when(F.col("depth") == 1, F.lit(least).cast("long")).otherwise(F.col("parent_conv_id"))
    nodes = nodes.where(~open_).withColumn("parent_conv_id", first).unionByName(joined)

    last = pieces.where("goes_on = 0").select(F.col("length").alias("depth"), F.col("e1").alias("d1"), F.col("e2").alias("d2"), "conv_id")
    last = last.unionByName(convs.where("length = 0").select(*(zero.alias(k) for k in KEY), "conv_id"))
    ends = last.repartition(*KEY).sortWithinPartitions(*KEY, "conv_id").mapInArrow(_ends, "depth long, d1 long, d2 long, ends_sha256 string")
    out = nodes.join(ends, KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
