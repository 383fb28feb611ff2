"""From raw documents to a training mix: five stages, each one operator over all rows it is given.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
docs. Between stages the rows are a written table, so a stage never runs twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dockflow.llm import decontaminate, exact_dedup, language_id, mixing, near_dedup
from dockflow.llm.common import ship, table, written
from dockflow.llm.queries import EPOCHS, SEED, SHARE, WEIGHTS, held_out, levels


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what has no letter, or no language with a score of one half."""
    ship(spark)
    return language_id.keep_identified(docs, language_id.train(docs.where(~held_out())))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dedup.drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, levels(), WEIGHTS, SHARE, EPOCHS, SEED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]
#: Language identification and the path trees of near duplicates have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
