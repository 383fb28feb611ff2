"""Mixing sources to target weights over a tree of budgets. DataFrame functions only.

Documents are leaves' rows: the `levels` columns, outermost first (domain, language, source), name
the path of a leaf. A budget of tokens goes down the tree. At each node it is shared among the
children by weight, and no child gets more than its subtree can give (its tokens times `epochs`);
what a child can't take goes to its siblings by their weights, and only what all of them can't
take was kept from this node before, by its own capacity, and went to its siblings. Shares are
whole tokens and add up to the budget exactly (rounded along the running sum of weights).

A leaf plays its documents in seeded epochs: in each, in order of md5(seed:epoch:doc_id). Its share
is a prefix of these epochs: whole epochs first, then the documents whose tokens before them are
fewer than what is left; the last one is taken up to that many tokens. Only a leaf's running sum
over `BUCKETS` sums of its order is in one task, and then the one bucket where the prefix ends.

Tokens are runs of `[^\\x20\\x09-\\x0D]`. A null in a level is a value of its own. A node without a given
weight has `default_weight`; weights below one give nothing. Null or empty texts have no tokens and
come with the epochs that reach them. Rows that tie in the order (equal doc_id) go by tokens, then
text; equal rows each count. A budget beyond the capacity takes all of it; an empty table gives no
rows. Columns of documents that clash with result columns are replaced by these.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockflow.llm.common import text_key, written

TOKEN = r"[^\x20\x09-\x0D]+"
BIG = "decimal(38,0)"
SALTS = 64


def n_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN)).cast("long")


def part(column: str | Column) -> Column:
    """A level's value as text that tells a null from any value."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    value = F.replace(F.replace(value, F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))
    return F.coalesce(F.concat(F.lit("="), value), F.lit("-"))


def weight_table(spark: SparkSession, weights: dict[tuple, int]) -> DataFrame:
    """(path, weight) from {(domain,): 3, (domain, language): 2, ...}; None stands for null. A level
    given as "*" holds for every value of it. Weights that aren't whole numbers are an error: shares
    like 0.6 and 0.4 are to be given as 3 and 2."""
    if broken := {k: w for k, w in weights.items() if w != w or w in (float("inf"), float("-inf")) or w != int(w)}:
        raise ValueError(f"weights must be whole numbers: {broken}")
    name = lambda x: "*" if x == "*" else "-" if x is None else "=" + str(x).replace("%", "%25").replace("/", "%2F")
    rows = [("/".join(name(x) for x in k), int(w)) for k, w in weights.items()]
    return spark.createDataFrame(rows, "path string, weight long")


def shared_out(children: DataFrame) -> DataFrame:
    """Adds `share` to rows (parent, path, capacity, weight, budget): the parent's budget by weight,
    no more than the capacity, what one can't take going to the others."""
    w, cap, budget = (F.col(k).cast(BIG) for k in ("weight", "capacity", "budget"))
    fill = F.col("capacity").cast("double") / F.col("weight")
    order = Window.partitionBy("parent").orderBy(fill, "path")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy("parent")
    zero = F.lit(0).cast(BIG)
    left = budget - F.coalesce(F.sum("capacity").over(before).cast(BIG), zero)
    full = (cap * F.sum("weight").over(after).cast(BIG) <= left * w).cast("int")
    fed = children.where("weight > 0").withColumn("full", F.min(full).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    open_ = F.col("full") == 0
    fed = fed.withColumn("rest", budget - F.coalesce(F.sum(F.when(~open_, F.col("capacity"))).over(whole).cast(BIG), zero))
    fed = fed.withColumn("all", F.sum(F.when(open_, F.col("weight"))).over(whole).cast(BIG))
    to = F.sum(F.when(open_, F.col("weight")).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast(BIG)
    fed = fed.withColumn("to", to)
    rest = F.col("rest").cast(BIG)
    part_ = F.expr("CAST(CAST(rest AS DECIMAL(25,0)) * CAST(`to` AS DECIMAL(13,0)) AS DECIMAL(38,0)) div `all`") - F.expr("CAST(CAST(rest AS DECIMAL(25,0)) * CAST(`to` - weight AS DECIMAL(13,0)) AS DECIMAL(38,0)) div `all`")
    return fed.withColumn("share", F.when(open_, part_).otherwise(F.col("capacity")).cast("long")).drop("full", "rest", "all", "to")


def budgets(slim: DataFrame, levels: Sequence[str], weights: DataFrame, budget: int, epochs: int, default_weight: int = 1) -> DataFrame:
    """(leaf, tokens, share) of every leaf that gets tokens, from rows with `tokens` and the levels."""
    parts = [part(c) for c in levels]
    leaf = slim.groupBy(*(p.alias(f"p{i}") for i, p in enumerate(parts))).agg(F.sum("tokens").alias("tokens"))
    names = [f"p{i}" for i in range(len(levels))]
    now = None
    for depth in range(1, len(levels) + 1):
        own = names[:depth]
        nodes = leaf.groupBy(*own).agg((F.sum("tokens") * epochs).alias("capacity"), F.sum("tokens").alias("tokens")).where("capacity > 0")
        nodes = nodes.withColumn("path", F.concat_ws("/", *own)).withColumn("parent", F.concat_ws("/", *own[:-1]))
        # Of the weights that fit, by a path with or without stars, the one with the fewest stars.
        fits = [([F.lit("*") if star else F.col(c) for star, c in zip(stars, own, strict=True)], sum(stars)) for stars in product((0, 1), repeat=depth)]
        fits = F.array(*(F.struct(F.concat_ws("/", *cols).alias("path"), F.lit(-n).alias("s")) for cols, n in fits))
        asked = nodes.select(F.col("path").alias("node"), F.explode(fits).alias("fit")).select("node", "fit.*")
        given = asked.join(weights, "path").groupBy(F.col("node").alias("path")).agg(F.max(F.struct("s", "weight"))["weight"].alias("weight"))
        nodes = nodes.join(given, "path", "left").withColumn("weight", F.coalesce("weight", F.lit(default_weight)))
        if now is None:
            nodes = nodes.withColumn("budget", F.least(F.lit(budget), F.sum("capacity").over(Window.partitionBy("parent"))))
        else:
            nodes = nodes.join(now.select(F.col("path").alias("parent"), F.col("share").alias("budget")), "parent")
        now = shared_out(nodes).where("share > 0").select("path", "tokens", "share")
    return now.withColumnRenamed("path", "leaf")


def select(slim: DataFrame, levels: Sequence[str], shares: DataFrame, seed: int, buckets: int = 3) -> DataFrame:
    """Rows of `slim` (doc_id, text_key, tokens, levels) with leaf, epoch, draw (the place in its
    order) and taken, once for every epoch they are taken in."""
    rows = slim.withColumn("leaf", F.concat_ws("/", *(part(c) for c in levels)))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALTS)))
    plan = shares.select("leaf", F.expr("share div tokens").alias("whole"), F.expr("share % tokens").alias("rest"))
    plan = plan.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    rows = written(rows.join(plan, ["leaf", "salt"]).drop("salt"), "rows")

    def draw(epoch: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col("doc_id").cast("string")).cast("binary"))

    full = rows.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)))
    full = full.withColumn("draw", draw(F.col("epoch"))).withColumn("taken", F.col("tokens"))

    some = rows.where("rest > 0").withColumn("epoch", F.col("whole")).withColumn("draw", draw(F.col("whole"))).withColumn("bucket", F.substring("draw", 1, buckets))
    sums = some.groupBy("leaf", "bucket").agg(F.sum("tokens").alias("in_bucket"), F.first("rest").alias("rest"))
    running = Window.partitionBy("leaf").orderBy("bucket")
    sums = sums.withColumn("before", F.sum("in_bucket").over(running) - F.col("in_bucket")).where("before < rest").select("leaf", "bucket", "before", "in_bucket")
    some = some.join(sums, ["leaf", "bucket"])
    inside = some.where("before + in_bucket <= rest").withColumn("taken", F.col("tokens"))
    edge = some.where("before + in_bucket > rest")
    order = Window.partitionBy("leaf").orderBy("draw", F.col("doc_id").asc_nulls_first(), "tokens", "text_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("left", F.col("rest") - F.col("before") - (F.sum("tokens").over(order) - F.col("tokens")))
    edge = edge.where("left > 0").withColumn("taken", F.least("left", "tokens"))
    names = [*slim.columns, "leaf", "epoch", "draw", "taken"]
    return full.select(*names).unionByName(inside.select(*names)).unionByName(edge.select(*names))


def mix(docs: DataFrame, levels: dict[str, Column], weights: dict[tuple, int], share: float, epochs: int, seed: int, default_weight: int = 1) -> DataFrame:
    """The selection of a budget of `share` of all tokens: doc_id, text_key, tokens, the levels, leaf,
    epoch, draw, taken. `levels` names each level's column."""
    slim = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), n_tokens(F.col("text")).alias("tokens"), *(c.alias(k) for k, c in levels.items())), "slim")
    total = slim.agg(F.sum("tokens")).first()[0] or 0
    names = list(levels)
    shares = written(budgets(slim, names, weight_table(docs.sparkSession, weights), int(total * share), epochs, default_weight), "shares")
    return select(slim, names, shares, seed)


def mixed_documents(docs: DataFrame, levels: dict[str, Column], weights: dict[tuple, int], share: float, epochs: int, seed: int) -> DataFrame:
    """The documents that are taken, once for each epoch: their columns, and epoch, draw and taken."""
    taken = mix(docs, levels, weights, share, epochs, seed).select(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"), "epoch", "draw", "taken").distinct()
    held = docs.select(F.struct(*(c for c in docs.columns if c not in ("epoch", "draw", "taken"))).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"))
    return held.join(taken, (held.text_key == taken.own_key) & held.doc_id.eqNullSafe(taken.own_id)).select("row.*", "epoch", "draw", "taken")
