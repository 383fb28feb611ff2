"""Benchmark passages in documents, by a positional inverted index. DataFrame functions only.

The index holds a posting (document, position) for every document word that some benchmark item
has, and one for each document's length; it is written once, in one pass over the texts. A phrase
is looked up from its rarest terms: the postings of the rarest, moved back by the term's offset,
are the phrase's possible starts; they are intersected with the postings of the next rarest. What
is left is compared in full with the document's words.

A proximity match is a start at which all terms of the phrase but one stand within `slop` positions
of their places (no term may be missing from a phrase of fewer than four). Its start is where one of
the two rarest terms stands in place; the second takes that part only if every term occurs in some
document, for else the rarest can't be the one that is missing. Terms that no document has count as
missing. Rarest means with fewest postings, then first in the phrase. `near_item_ids` are the items
with a proximity match in a document, but no exact one.

A phrase is `size` consecutive words of an item, or all words of a shorter one; words are
`[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. Null or empty texts have no words; items without
words, and those without an item_id, are in no result (the latter's phrases still hit). Repeated
rows get equal results; equal items count once. Only doc_id, text and item_id are read. Tables that
come from the benchmark are broadcast up to `most` rows, and joined by shuffle beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.llm.common import keyed, lower_ascii, text_key, written

SIZE, SLOP = 10, 3
MOST_ROWS = 1_000_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOC = ["doc_id", "text_key"]


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def _sized(frame: DataFrame, most: int) -> DataFrame:
    """A broadcast hint for a written table of at most `most` rows."""
    return F.broadcast(frame) if frame.count() <= most else frame


def phrases(items: DataFrame, size: int = SIZE) -> DataFrame:
    """(item_id, phrase): the distinct phrases of each item, arrays of words."""
    own = items.select("item_id", words(F.coalesce("text", F.lit(""))).alias("w")).where(F.size("w") > 0)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1))), lambda i: F.slice("w", i, size))
    return own.select("item_id", F.explode(cut).alias("phrase")).distinct()


def index(docs: DataFrame, terms: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """(doc_id, text_key, n_words, pos, term_id) for the given (term, term_id); the posting of term ''
    at position 0 stands for the document, word positions count from 1."""
    own = keyed(docs).select(*DOC, words(F.col("text")).alias("w"))
    spread = own.select(*DOC, F.size("w").alias("n_words"), F.posexplode(F.concat(F.array(F.lit("")), "w")).alias("pos", "term"))
    return spread.join(_sized(terms, most), "term").drop("term")


def may_miss(n: Column) -> Column:
    """How many of a phrase's n terms may be missing in a proximity match."""
    return F.when(n >= 4, 1).otherwise(0)


def lookups(found: DataFrame, index_: DataFrame, near: bool = True) -> DataFrame:
    """(phrase_id, term_id, offset, bits): the rare terms by which each phrase is looked up, the two
    rarest of a phrase whose terms all occur; with `near`, those that hold if one term is missing.
    Bits 1, 2 and 4 are the term's rank, 8 says that the second may be in place of the first."""
    counts = index_.where("pos > 0").groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))
    spread = found.select("phrase_id", "n", F.posexplode("term_ids").alias("offset", "term_id"))
    missing = may_miss(F.col("n")) if near else F.lit(0)
    ranked = (
        spread.join(counts, "term_id").groupBy("phrase_id", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "offset", "term_id"))).alias("by"))
        .where(F.size("by") >= F.col("n") - missing)
    )
    both = (missing > 0) & (F.size("by") == F.col("n"))
    single = F.when(F.size("by") == 1, 2).otherwise(0)
    rare = ranked.select("phrase_id", both.alias("both"), single.alias("single"), F.posexplode(F.slice("by", F.lit(1), F.when(both, 3).otherwise(2))).alias("rank", "t"))
    bits = F.expr("shiftleft(1, rank)").bitwiseOR(F.col("single")).bitwiseOR(F.when(F.col("both"), 8).otherwise(0))
    return rare.select("phrase_id", F.col("t.term_id").alias("term_id"), F.col("t.offset").alias("offset"), bits.alias("bits"))


def candidates(places: DataFrame, wanted: DataFrame, reach: int) -> DataFrame:
    """(doc_id, text_key, phrase_id, start) where a rare term stands in place and another within `reach`."""
    start = (F.col("pos") - F.col("offset")).alias("start")
    starts = places.join(wanted, "term_id").select(*DOC, "phrase_id", start, "bits")
    # One exchange, in the order of the documents, for the aggregate and the window. Rows that repeat
    # doc_id and text have the same postings; they become one here, a task for each phrase.
    starts = starts.repartition(*DOC, "phrase_id") if reach else starts
    own = starts.groupBy(*DOC, "phrase_id", "start").agg(F.bit_or("bits").alias("own"))
    if reach:
        around = Window.partitionBy(*DOC, "phrase_id").orderBy("start").rangeBetween(-reach, reach)
        own = own.withColumn("all", F.bit_or("own").over(around))
    else:
        own = own.withColumn("all", F.col("own"))

    def has(name: str, bits: int) -> Column:
        return F.col(name).bitwiseAND(F.lit(bits)) != 0

    return own.where((has("own", 1) & has("all", 6)) | (has("own", 8) & has("own", 2) & has("all", 5))).select(*DOC, "phrase_id", "start")


def _stands(phrase: Column, start: Column, w: Column, slop: int) -> Column:
    """How many terms of the phrase have a posting within `slop` of their place."""

    def near_place(i: Column) -> Column:
        low = F.greatest(start + i - slop, F.lit(1))
        size = F.greatest(start + i + slop - low + 1, F.lit(0))
        return F.array_contains(F.slice(w, low, size), F.get(phrase, i))

    return F.size(F.filter(F.sequence(F.lit(0), F.size(phrase) - 1), near_place))


def matches(docs: DataFrame, items: DataFrame, size: int = SIZE, slop: int = SLOP, most: int = MOST_ROWS, near: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents (doc_id, text_key, n_words); matches (doc_id, text_key, start, n, phrase_id, exact),
    with `near` the proximity matches among them; and (item_id, phrase_id)."""
    of_item = phrases(items, size)
    named = written(of_item.groupBy("phrase").agg(F.collect_set("item_id").alias("item_ids")).withColumn("phrase_id", F.monotonically_increasing_id()), "phrases")
    terms = named.select(F.explode("phrase").alias("term")).distinct().withColumn("term_id", F.monotonically_increasing_id())
    blank = docs.sparkSession.createDataFrame([("", -1)], "term string, term_id long")
    terms = written(terms.unionByName(blank), "terms")
    postings = written(index(docs, terms, most), "postings")
    documents = postings.where("pos = 0").select(*DOC, "n_words")

    spread = named.select("phrase_id", F.posexplode("phrase").alias("at", "term")).join(terms, "term")
    found = spread.groupBy("phrase_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "term_id"))), lambda x: x["term_id"]).alias("term_ids")).withColumn("n", F.size("term_ids"))
    wanted = written(lookups(found, postings, near), "lookups")

    places = postings.where("pos > 0").select(*DOC, "pos", "term_id")
    likely = candidates(places, _sized(wanted, most), slop if near else 0)

    possible = likely.join(named.select("phrase_id", "phrase"), "phrase_id")
    per_doc = possible.groupBy(*DOC).agg(F.collect_list(F.struct("phrase_id", "start", "phrase")).alias("possible")).toDF("own_id", "own_key", "possible")
    per_doc = written(per_doc, "possible")
    text = keyed(docs)
    there = text.join(per_doc, (text.text_key == per_doc.own_key) & text.doc_id.eqNullSafe(per_doc.own_id)).select(*DOC, words(F.col("text")).alias("w"), "possible")

    def judged(c: Column) -> Column:
        n = F.size(c["phrase"])
        exact = (c["start"] >= 1) & (F.slice(F.col("w"), F.greatest(c["start"], F.lit(1)), n) == c["phrase"])
        close = _stands(c["phrase"], c["start"], F.col("w"), slop) >= n - may_miss(n) if near else F.lit(False)
        return F.struct(c["start"].alias("start"), n.alias("n"), c["phrase_id"].alias("phrase_id"), exact.alias("exact"), (exact | close).alias("holds"))

    held = there.select(*DOC, F.explode(F.filter(F.transform("possible", judged), lambda c: c["holds"])).alias("c"))
    held = held.select(*DOC, "c.start", "c.n", "c.phrase_id", "c.exact").distinct()
    return documents, held, named.select("phrase_id", F.explode("item_ids").alias("item_id"))


def contamination(docs: DataFrame, items: DataFrame, size: int = SIZE, slop: int = SLOP, most: int = MOST_ROWS, near: bool = True) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, item_ids and near_item_ids (sorted strings) of every row;
    without `near`, proximity matches are not looked for."""
    documents, held, of_phrase = matches(docs, items, size, slop, most, near)
    held = written(held, "matches")
    exact, close = held.where("exact"), held.where("not exact")
    covered = F.flatten(F.collect_list(F.sequence("start", F.col("start") + F.col("n") - 1)))
    hit = exact.groupBy(*DOC).agg(F.size(F.array_distinct(covered)).alias("n_hit"))

    def items_of(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(*DOC, "phrase_id").distinct().join(of_phrase, "phrase_id").groupBy(*DOC).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias(name))

    out = documents
    for more in (hit, items_of(exact, "item_ids"), items_of(close, "near_item_ids")):
        name = more.columns[2:]
        more = more.toDF("own_id", "own_key", *name)
        out = out.join(more, (out.text_key == more.own_key) & out.doc_id.eqNullSafe(more.own_id), "left").drop("own_id", "own_key")
    empty = F.array().cast("array<string>")
    exact_ids = F.coalesce("item_ids", empty)
    return out.select(
        *DOC, F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        exact_ids.alias("item_ids"), F.array_except(F.coalesce("near_item_ids", empty), exact_ids).alias("near_item_ids"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """The documents in which no phrase of an item occurs, all columns kept."""
    return keep_clean(docs, contamination(docs, items, size, near=False))


def keep_clean(docs: DataFrame, found: DataFrame) -> DataFrame:
    held = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"))
    out = found.where("n_hit > 0").select(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key")).distinct()
    return held.join(out, (held.text_key == out.own_key) & held.doc_id.eqNullSafe(out.own_id), "left_anti").select("row.*")
