"""The registered queries of this subpackage and their SQL, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.llm import (
    decontaminate, exact_dedup, fill_middle, language_id, license_scan, lm_score, mixing, near_dedup, prefix_trie, quality, repeat_spans, secret_scan, sharding,
)
from dockflow.llm.common import ship, table
from dockflow.llm.sql import SQL

KEEP_SCORE = 0.3
#: The tree is domain, language, source; source numbers make four domains.
WEIGHTS = {("d0",): 4, ("d1",): 3, ("d2",): 2, ("d3",): 1, ("*", "en"): 5, ("*", "de"): 2, ("*", "fr"): 2, ("*", "es"): 4}
SHARE, EPOCHS, SEED = 0.5, 2, 17
SHARDS = 8


def levels() -> dict[str, Column]:
    number = F.regexp_extract("source", "[0-9]+", 0).try_cast("int")
    return {"domain": F.concat(F.lit("d"), F.pmod(number, F.lit(4)).cast("string")), "lang": F.col("lang"), "source": F.col("source")}


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    out = mixing.mix(table(spark, folder, "documents"), levels(), WEIGHTS, SHARE, EPOCHS, SEED)
    return out.select("doc_id", "domain", "lang", "source", "tokens", "epoch", "draw", "taken")


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.train(docs.where(~held_out()), labels.where(~held_out()))
    return quality.scores(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return secret_scan.scan(table(spark, folder, "documents"))


def op4_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    out = lm_score.scores(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", F.round("log_score", 2).alias("log_score"), F.round("mean", 4).alias("mean"))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return near_dedup.near_groups(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    docs = table(spark, folder, "documents")
    model = language_id.train(docs.where(~held_out()))
    return language_id.languages(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return license_scan.scan(table(spark, folder, "documents"))


def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    out = repeat_spans.remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_item_ids").cast("long").alias("n_near_items"), F.sha2(F.concat_ws(",", "near_item_ids").cast("binary"), 256).alias("near_items_sha256"),
    )


def op11_sharding(spark: SparkSession, folder: str) -> DataFrame:
    out = sharding.shard(table(spark, folder, "documents"), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    out = fill_middle.restored(fill_middle.fill_in_middle(table(spark, folder, "documents")))
    digests = (F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    turns = prefix_trie.numbered(table(spark, folder, "conversations"))
    return prefix_trie.prefix_nodes(*prefix_trie.shared_openings(turns)).withColumnRenamed("saved", "saved_tokens")


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing, op2_quality, op3_secrets, op4_lm_score, op5_exact_dedup, op6_near_dedup, op7_language, op8_licenses, op9_repeats, op10_decontaminate,
        op11_sharding, op12_fill_middle, op13_prefix_trie, pipeline,
    )
}
ORACLE = SQL
