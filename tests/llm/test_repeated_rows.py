"""Many rows of one doc_id and text."""

import time

from pyspark.sql import functions as F

from dockflow.llm import decontaminate


def test_equal_rows_do_not_meet_each_other(spark):
    phrase = " ".join(f"w{i}" for i in range(30))
    items = spark.createDataFrame([("a", phrase), ("b", "another item of ten words that no document has at all")], "item_id string, text string")
    one = spark.createDataFrame([(None, f"before {phrase} after")], "doc_id long, text string")
    begun = time.perf_counter()
    rows = decontaminate.contamination(one.crossJoin(spark.range(20_000)).drop("id").repartition(8), items)
    found = rows.groupBy("n_words", "n_hit", F.concat_ws(",", "item_ids").alias("items")).count().collect()
    assert [tuple(r) for r in found] == [(32, 30, "a", 20_000)]
    assert time.perf_counter() - begun < 240  # 20,000 squared, for 21 phrases, would take hours


def test_empty_benchmark(spark):
    items = spark.createDataFrame([], "item_id string, text string")
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    found = sorted((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.near_item_ids) for r in decontaminate.contamination(docs, items).collect())
    assert found == [(1, 2, 0, [], []), (2, 0, 0, [], [])]
    assert decontaminate.drop_contaminated(docs, items).count() == 2
