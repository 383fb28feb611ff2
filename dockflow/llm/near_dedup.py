"""Near duplicates on word shingles by chosen-path set similarity.

Documents with the same words are one class, found by a shuffle of hashes. Classes are then
branched: a tree sends a document down from a node along `BRANCH` minwise tokens, chosen by the
node, to the children named by these tokens, so that documents that share chosen paths meet.
Nodes of at most `node_limit` documents are compared exhaustively (on signatures). In larger ones
the documents are linked to those of the node's `PIVOTS` pivots that they are like. Each document
has a label, the name of a document that links join it to. Where at most `node_limit` documents are
outside the commonest label, these are compared with all of the node, which then is done;
otherwise all documents branch again, and children whose documents have one label are dropped. So
a group of copies doesn't multiply, and no two documents part that links don't join: a link is
lost only where the signatures or all trees miss it. Of two documents at the threshold a tree finds the link with a chance of 0.94
at its first level and, as q = 1 - (1 - 0.75 q)^2, 0.889 or more at any depth; `TREES` of them miss it with 2.3e-8 or
less (coordinates taken as independent). What the comparison proposes joins documents to candidate groups, and every
candidate group is decided on full shingle sets, which travel once.

A large group is decided in blocks of bounded size: all blocks against one block, then what that
has not joined against all blocks; no task holds a group and no pairs are emitted within it.

Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; five words make a shingle, a shorter text is
one shingle, a text without words (or null) has the empty set and is linked with nothing.
Repeated rows (equal doc_id and text) get equal results. A null doc_id never names a component
unless all its members have none. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import keep_rows, keyed, pieces, written
from dockflow.llm.components import components
from dockflow.llm.textbytes import U, mix, shingle_hashes, text_of, word_hashes

WORDS, PERCENT = 5, 75
COORDS, TREES, BRANCH, DEPTH = 64, 8, 2, 12
NODE_LIMIT = 1000
PIVOTS = 48
#: Signatures of documents at the threshold agree in fewer places with a chance of about 5e-06.
AGREE = COORDS // 2
#: For links to pivots: these only give labels, and candidate groups are decided on full sets.
AGREE_PIVOT = COORDS * 2 // 5
#: Documents that a task settles at once.
SETTLED_ROWS = 20_000
#: Shingles that a task decides at once.
GROUP_SHINGLES = 4_000_000
ODD = mix(np.arange(1, COORDS + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)
SHIFT = mix(np.arange(101, COORDS + 101, dtype=U) * U(0x9E3779B97F4A7C15))


def _sequence(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's whole sequence of words."""
    rank = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
    out = []
    for salt in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3):
        total = np.concatenate([np.zeros(1, U), np.cumsum(mix(words ^ mix(rank.astype(U) * U(2) + U(salt))))])
        out.append(mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(U)).view(np.int64))
    return out[0], out[1]


def _distinct(shingles: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    return [np.unique(shingles[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The smallest of each text's tokens under COORDS hash functions (empty sets: 0)."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    out = np.zeros((len(sets), COORDS), dtype=U)
    full = np.flatnonzero(sizes)
    if len(full):
        tokens = np.concatenate([sets[i] for i in full])
        cuts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        for k in range(COORDS):
            x = (tokens ^ SHIFT[k]) * ODD[k]
            x ^= x >> U(32)
            x *= ODD[-1 - k]
            out[full, k] = np.minimum.reduceat(x, cuts)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            words, first = word_hashes(text_of(piece))
            one, two = _sequence(words, first)
            sets = _distinct(*shingle_hashes(words, first, WORDS))
            rows = _signatures(sets).tobytes()
            wide = 8 * COORDS
            yield pa.RecordBatch.from_arrays([
                text_of(piece, "doc_id"), text_of(piece, "text_key"), pa.array(one), pa.array(two), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([rows[i * wide : (i + 1) * wide] for i in range(len(piece))], pa.binary()),
            ], ["doc_id", "text_key", "seq1", "seq2", "n_shingles", "signature"])


def _children(path: np.ndarray, signature: np.ndarray, root: bool) -> tuple[np.ndarray, np.ndarray]:
    """Children that each (node, document) goes to, and the row that each comes from."""
    n = len(signature)
    if root:  # each tree has coordinates of its own
        picks = np.tile(np.arange(TREES * BRANCH), (n, 1))
        salt = np.tile(np.repeat(mix(np.arange(TREES, dtype=U)), BRANCH), (n, 1))
    else:
        one = mix(path) % U(COORDS)
        picks = np.column_stack([one, (one + U(1) + mix(path + U(1)) % U(COORDS - 1)) % U(COORDS)]).astype(np.int64)
        salt = np.repeat(path[:, None], BRANCH, axis=1)
    value = np.take_along_axis(signature, picks, axis=1)
    child = mix(mix(salt + picks.astype(U)) ^ value)
    return child.ravel(), np.repeat(np.arange(n), picks.shape[1])


def _branch(frame: DataFrame, root: bool) -> DataFrame:
    def down(batches):
        for batch in batches:
            if not len(batch):
                continue
            signature = np.frombuffer(b"".join(text_of(batch, "signature").to_pylist()), dtype=U).reshape(-1, COORDS)
            path = np.zeros(len(batch), U) if root else text_of(batch, "path").to_numpy().view(U)
            child, row = _children(path, signature, root)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), *(text_of(batch, k).take(at) for k in ("rep", "label"))], ["path", "rep", "label"])

    return frame.mapInArrow(down, "path long, rep long, label long")


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The low byte of each coordinate: enough to see how many agree."""
    for batch in batches:
        whole = np.frombuffer(b"".join(text_of(batch, "signature").to_pylist()), dtype=U).astype(np.uint8).tobytes()
        yield pa.RecordBatch.from_arrays([text_of(batch, "rep"), pa.array([whole[i * COORDS : (i + 1) * COORDS] for i in range(len(batch))], pa.binary())], ["rep", "few"])


def _pivot_labels(marks: np.ndarray, labels: list[int], least: int) -> tuple[list[int], list[tuple[int, int]]]:
    """A label for each pivot, equal for those that are alike or had equal labels, and the links of the former."""
    out, links = list(labels), []
    for i, j in np.argwhere(np.triu((marks[:, None] == marks).sum(axis=2) >= least, 1)).tolist():
        links.append((i, j))
        out = [out[i] if x == out[j] else x for x in out]
    return out, links


def _settle(least: int, label_pivots: bool):
    """Rows sorted by (path, part), a node's pivots before its documents. Gives links (pivot, rep)
    and, if asked, with a null pivot, each document with its new label."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, pivots, marks = None, [], None
        for batch in batches:
            out: list[tuple] = []
            joined: set[tuple[int, int]] = set()
            for path, part, kind, rep, label, few in zip(*(text_of(batch, k).to_pylist() for k in ("path", "part", "kind", "rep", "label", "few")), strict=True):
                if node != (path, part):
                    node, pivots, marks = (path, part), [], None
                if kind == 0:
                    pivots.append((rep, label, few))
                    continue
                if marks is None:
                    marks = np.frombuffer(b"".join(x[2] for x in pivots), dtype=np.uint8).reshape(-1, COORDS)
                    names, old = [x[0] for x in pivots], [x[1] for x in pivots]
                    if label_pivots:
                        new, alike = _pivot_labels(marks, old, least)
                        joined |= {(names[i], names[j]) for i, j in alike}
                        relabel = dict(zip(old, new, strict=True))
                same = (marks == np.frombuffer(few, dtype=np.uint8)).sum(axis=1) if names else np.zeros(0, int)
                like = np.flatnonzero(same >= least)
                if len(like):
                    first = names[like[0]]
                    joined |= {(first, names[i]) for i in like[1:]}
                    joined.add((first, rep))
                if label_pivots:
                    out.append((path, rep, None, new[like[0]] if len(like) else relabel.get(label, label), few))
            out += [(None, rep, pivot, None, None) for pivot, rep in joined if pivot != rep]
            columns = [pa.array([x[i] for x in out], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x[4] for x in out], pa.binary())], ["path", "rep", "pivot", "label", "few"])

    return settle


def _dealt(pivots: DataFrame, rows: DataFrame, least: int, label_pivots: bool) -> DataFrame:
    """`_settle` of the rows (path, rep, label, few, n) against the pivots of their nodes; a large node is dealt out in parts."""
    parts = F.ceil(F.col("n") / SETTLED_ROWS)
    pivots = pivots.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).withColumn("kind", F.lit(0))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("rep"), parts)).withColumn("kind", F.lit(1))
    names = ["path", "part", "kind", "rep", "label", "few"]
    both = pivots.select(*names).unionByName(rows.select(*names)).repartition("path", "part").sortWithinPartitions("path", "part", "kind")
    return both.mapInArrow(_settle(least, label_pivots), "path long, rep long, pivot long, label long, few binary")


def _settled(large: DataFrame) -> DataFrame:
    """From rows (path, rep, label, few, n) of large nodes: links (rep, pivot), and all rows with new
    labels. Pivots are chosen by hash, some PIVOTS of a node."""
    chance = F.pmod(F.xxhash64("path", "rep"), F.lit(1 << 40)) / float(1 << 40)
    return _dealt(large.where(chance < F.lit(PIVOTS) / F.col("n")), large, AGREE_PIVOT, True)


def _by_label(rows: DataFrame) -> DataFrame:
    """(path, n, big, others): rows of each node, its commonest label, and the rows of other labels."""
    sizes = rows.groupBy("path", "label").agg(F.count(F.lit(1)).alias("m"))
    nodes = sizes.groupBy("path").agg(F.sum("m").alias("n"), F.max(F.struct("m", "label")).alias("x"))
    return nodes.select("path", "n", F.col("x.label").alias("big"), (F.col("n") - F.col("x.m")).alias("others"))


def _forest(few: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that join all documents whose signatures agree: a spanning forest, not all pairs."""
    left = np.arange(len(few))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = (few[left] == few[at]).sum(axis=1) >= AGREE
            for x in left[near]:
                yield at, x
                queue.append(x)
            left = left[~near]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node; the rows of a node may go over several batches."""

    def links(held: list[tuple[np.ndarray, np.ndarray, list[bytes]]]) -> list[tuple[int, int]]:
        path = np.concatenate([h[0] for h in held])
        rep = np.concatenate([h[1] for h in held])
        few = np.frombuffer(b"".join(b"".join(h[2]) for h in held), dtype=np.uint8).reshape(-1, COORDS)
        out = []
        cuts = np.concatenate([[0], np.flatnonzero(path[1:] != path[:-1]) + 1, [len(path)]])
        size = np.diff(cuts)
        pair = cuts[:-1][size == 2]
        near = pair[(few[pair] == few[pair + 1]).sum(axis=1) >= AGREE]
        out += zip(rep[near].tolist(), rep[near + 1].tolist(), strict=True)
        for a, b in zip(cuts[:-1][size > 2], cuts[1:][size > 2], strict=True):
            out += [(int(rep[a + i]), int(rep[a + j])) for i, j in _forest(few[a:b])]
        return out

    def batch_of(pairs):
        pairs = list(dict.fromkeys(pairs))
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in pairs], pa.int64()), pa.array([x[1] for x in pairs], pa.int64())], ["a", "b"])

    held: list = []
    for batch in batches:
        if not len(batch):
            continue
        path = text_of(batch, "path").to_numpy()
        rep, few = text_of(batch, "rep").to_numpy(), text_of(batch, "few").to_pylist()
        cut = int(np.searchsorted(path, path[-1]))  # the last node may go on
        if cut:
            held.append((path[:cut], rep[:cut], few[:cut]))
            yield batch_of(links(held))
            held = []
        elif held and held[-1][0][-1] != path[0]:
            yield batch_of(links(held))
            held = []
        held.append((path[cut:], rep[cut:], few[cut:]))
    if held:
        yield batch_of(links(held))


def candidates(reps: DataFrame, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Links (a, b) of rows of `reps` (rep, signature) whose signatures agree, enough to connect them."""
    few = written(reps.mapInArrow(_few, "rep long, few binary"), "few")
    found: list[DataFrame] = []
    link = (F.col("rep").alias("a"), F.col("pivot").alias("b"))
    nodes = _branch(reps.withColumn("label", F.col("rep")), True)
    for depth in range(1, DEPTH + 1):
        nodes = written(nodes, "paths")
        if depth == 1:  # all labels differ
            sizes = nodes.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        else:
            sizes = _by_label(nodes).where("others > 0").select("path", "n")
        nodes = written(nodes.join(sizes, "path").join(few, "rep"), "nodes")
        small = nodes.where(F.col("n") <= node_limit).repartition("path").sortWithinPartitions("path")
        found.append(small.mapInArrow(_compare, "a long, b long"))
        large = nodes.where(F.col("n") > node_limit)
        if large.isEmpty():
            break
        settled = written(_settled(large), "settled")
        found.append(settled.where("pivot is not null").select(*link))
        rest = settled.where("pivot is null").drop("pivot")
        rest = rest.join(written(_by_label(rest).where("others > 0"), "labels"), "path")
        last = rest.where(F.col("others") <= node_limit)
        found.append(written(_dealt(last.where("label <> big"), last, AGREE, False), "last").select(*link))
        rest = rest.where(F.col("others") > node_limit).select("path", "rep", "label")
        if depth == DEPTH:  # what has shared this many tokens without being like others is one group
            first = rest.groupBy("path").agg(F.min("rep").alias("b"))
            found.append(rest.join(first, "path").where("rep <> b").select(F.col("rep").alias("a"), "b"))
        nodes = _branch(rest.join(reps, "rep"), False)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def _linked(tokens: np.ndarray, sizes: np.ndarray, start: np.ndarray, percent: int) -> np.ndarray:
    """A label per document, equal for those joined by links on full sets. Links within a label of
    `start` aren't looked for. A document that is explored has all its links found; it is enough to
    explore until all others share one label, as a link that isn't found then joins nothing."""
    label = start.copy()
    begin = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.unique(tokens, return_inverse=True)[1]
    held = np.zeros(int(ids.max(initial=-1)) + 1, dtype=np.int64)
    done = np.zeros(len(sizes), dtype=bool)
    while True:
        names, counts = np.unique(label, return_counts=True)
        left = np.flatnonzero(~done & (label != names[counts.argmax()]))
        if not len(left):
            return label
        d = left[0]
        mine = ids[begin[d] : begin[d + 1]]
        held[mine] = 1
        common = np.add.reduceat(held[ids], begin[:-1])
        held[mine] = 0
        near = 100 * common >= percent * (sizes + sizes[d] - common)
        near[d] = done[d] = True
        label[np.isin(label, label[near])] = label[d]


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            sets = _distinct(*shingle_hashes(*word_hashes(text_of(piece)), WORDS))
            yield pa.RecordBatch.from_arrays([*(text_of(piece, k) for k in ("group", "rep", "n_group")), pa.array([x.tobytes() for x in sets], pa.binary())], ["group", "rep", "n_group", "tokens"])


def _decided(rep: np.ndarray, tokens: list[bytes], start: np.ndarray, percent: int) -> np.ndarray:
    """For each document the smallest rep of its label."""
    sizes = np.array([len(t) // 8 for t in tokens], dtype=np.int64)
    label = _linked(np.frombuffer(b"".join(tokens), dtype=U), sizes, start, percent)
    names, at = np.unique(label, return_inverse=True)
    least = np.full(len(names), np.iinfo(np.int64).max)
    np.minimum.at(least, at, rep)
    return least[at]


def _decide_runs(percent: int):
    """Rows sorted by group, each group of bounded size; a group may go over several batches."""

    def decide(batches):
        held: list[tuple[int, int, bytes]] = []

        def done():
            rep = np.array([x[1] for x in held], dtype=np.int64)
            label = _decided(rep, [x[2] for x in held], np.arange(len(rep)), percent) if len(rep) > 1 else rep
            return pa.RecordBatch.from_arrays([pa.array(rep), pa.array(label)], ["node", "component"])

        for batch in batches:
            for row in zip(*(text_of(batch, k).to_pylist() for k in ("group", "rep", "tokens")), strict=True):
                if held and held[0][0] != row[0]:
                    yield done()
                    held = []
                held.append(row)
        if held:
            yield done()

    return decide


def _decide_blocks(members: DataFrame, percent: int, most: int) -> DataFrame:
    """Groups of any size: every block against one block of the group, then the documents outside
    the group's largest component against all blocks. Returns (node, component)."""
    blocks = F.ceil(2 * F.col("n_group") / F.lit(most)).cast("long")
    members = written(members.withColumn("block", F.pmod(F.xxhash64("rep"), blocks)), "members")
    schema = "a long, b long"

    def within(table: pa.Table) -> pa.Table:
        rep, at = np.unique(table.column("rep").to_numpy(), return_index=True)
        tokens, start = table.column("tokens").to_pylist(), table.column("label").to_numpy()
        label = _decided(rep, [tokens[i] for i in at], start[at], percent)
        return pa.table({"a": rep, "b": label})

    own = members.withColumn("label", F.col("rep"))
    first = own.where("block = 0").drop("block").join(members.select("group", "block").distinct(), "group")
    links = own.unionByName(first).groupBy("group", "block").applyInArrow(within, schema)
    found = components(links)
    label = F.coalesce("component", "rep").alias("label")
    labelled = written(members.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("group", "rep", "tokens", "block", "n_group", label), "labelled")
    sizes = labelled.groupBy("group", "label").agg(F.count(F.lit(1)).alias("n"))
    biggest = sizes.groupBy("group").agg(F.max(F.struct("n", "label")).alias("x")).select("group", F.col("x.label").alias("big"))
    rest = labelled.join(biggest, "group").where("label <> big").drop("big")
    queries = rest.withColumn("part", F.col("block")).drop("block")
    cells = queries.select("group", "part").distinct().join(labelled.select("group", "block").distinct(), "group")
    both = labelled.join(cells, ["group", "block"]).unionByName(queries.join(cells, ["group", "part"]))
    more = both.groupBy("group", "part", "block").applyInArrow(within, schema)
    return components(links.unionByName(written(more, "more")))


def near_components(classes: DataFrame, docs: DataFrame, percent: int, node_limit: int, most: int) -> DataFrame:
    """(node, component) of all classes with a candidate link, decided on full sets."""
    reps = classes.select("rep", "signature")
    groups = written(components(candidates(reps, node_limit)).toDF("rep", "group"), "groups")
    members = classes.select("rep", "doc_id", "text_key", "n_shingles").join(groups, "rep")
    total = members.groupBy("group").agg(F.sum("n_shingles").alias("n_group"))
    members = members.join(total, "group")
    text = keyed(docs)
    named = members.select("group", "rep", "n_group", F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"))
    there = text.join(named, (text.text_key == named.own_key) & text.doc_id.eqNullSafe(named.own_id)).dropDuplicates(["rep"])
    sets = written(there.select("group", "rep", "n_group", "text").mapInArrow(_tokens, "group long, rep long, n_group long, tokens binary"), "sets")
    schema = "node long, component long"
    found = sets.where(F.col("n_group") <= most).repartition("group").sortWithinPartitions("group").mapInArrow(_decide_runs(percent), schema)
    large = sets.where(F.col("n_group") > most)
    if not large.isEmpty():
        found = found.unionByName(_decide_blocks(large, percent, most))
    return found


def near_groups(docs: DataFrame, percent: int = PERCENT, node_limit: int = NODE_LIMIT, most: int = GROUP_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, and text_key and `survivor` (one row's key of each component)."""
    sketch = written(keyed(docs).mapInArrow(_sketch, "doc_id long, text_key long, seq1 long, seq2 long, n_shingles long, signature binary"), "sketch")
    name = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "text_key")
    classes = (
        sketch.where("n_shingles > 0").groupBy("seq1", "seq2")
        .agg(F.min(F.struct(name.alias("name"), "n_shingles", "signature")).alias("x"))
        .select(F.monotonically_increasing_id().alias("rep"), "seq1", "seq2", "x.name.doc_id", "x.name.text_key", "x.n_shingles", "x.signature")
    )
    classes = written(classes, "classes")
    found = written(near_components(classes, docs, percent, node_limit, most), "components")
    joined = classes.select("rep", "seq1", "seq2", "doc_id", "text_key").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    joined = joined.withColumn("component", F.coalesce("component", "rep"))
    first = joined.groupBy("component").agg(F.min(name).alias("first"))
    named = joined.join(first, "component").select("seq1", "seq2", "first")
    slim = sketch.select("doc_id", "text_key", "seq1", "seq2", "n_shingles")
    own = F.when(F.col("n_shingles") > 0, F.col("first")).otherwise(name)
    return (
        slim.join(named, ["seq1", "seq2"], "left")
        .select("doc_id", "text_key", "n_shingles", own.alias("first"))
        .select(
            "doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"),
            F.col("doc_id").eqNullSafe(F.col("first.doc_id")).alias("kept"), "text_key",
            (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))).alias("survivor"),
        )
    )


def drop_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents with one of each component, all columns kept."""
    return keep_rows(docs, near_groups(docs, percent).where("survivor"))
