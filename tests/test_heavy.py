"""The busiest groups, against a full count."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dockflow.operators.heavy import busiest_groups, contenders
from dockflow.operators.ranking import by_name

KEYS = ["name", "lat"]


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "name string, lat double, n long").repartition(5)


def expected(rows, k):
    counts = Counter()
    for name, lat, n in rows:
        counts[name, lat + 0.0] += n
    order = sorted(counts.items(), key=lambda x: (-x[1], x[0][0] is None, x[0][0] or "", x[0][1]))
    return [(*group, rides) for group, rides in order[:k]]


def found(frame, k, buckets):
    return [tuple(r) for r in busiest_groups(frame, KEYS, k, *by_name(*KEYS), buckets=buckets).collect()]


def skewed(seed, tail=6000):
    """A group with a third of all rows, some busy ones, and positions that differ in every row."""
    rng = random.Random(seed)
    rows = [(f"t{i % 50}", rng.random(), 1) for i in range(tail)]
    rows += [("hot", 1.5, 1)] * (tail // 2)
    for i in range(12):
        rows += [(f"busy{i}", 2.5, 1)] * (60 + 10 * (i // 2))
    rows += [(None, 3.5, 1)] * 100 + [("zero", 0.0, 1)] * 60 + [("zero", -0.0, 1)] * 60
    rng.shuffle(rows)
    return rows


CASES = {
    "skewed": skewed(1),
    "all differ": [(f"t{i}", i / 7, 1) for i in range(500)],
    "all equal": [("a", 1.0, 1)] * 300,
    "ties": [(f"t{i % 40}", 1.0, 1) for i in range(400)],
    "weighted": [(f"t{i}", 1.0, i % 90) for i in range(400)],
    "empty": [],
}


@pytest.mark.parametrize("buckets", [1, 16, 4096])
@pytest.mark.parametrize("case", CASES)
def test_busiest_groups(spark, case, buckets):
    rows = CASES[case]
    assert found(frame_of(spark, rows), 10, buckets) == expected(rows, 10)


def test_most_rows_are_left_out_before_the_grouping(spark):
    rows = skewed(2, 30_000)
    kept = contenders(frame_of(spark, rows), KEYS, 10, 4096)
    tail = kept.filter(F.col("name").startswith("t")).count()
    assert tail < 600  # of 30,000; the rest shares a bucket with a busy group
    full = Counter(r[0] for r in rows if r[0] and not r[0].startswith("t"))
    held = {r["name"]: r["count"] for r in kept.groupBy("name").count().collect()}
    assert held["hot"] == full["hot"]


@pytest.mark.parametrize("buckets", [131_072, 100])
def test_broadcast_is_bounded(spark, buckets):
    with pytest.raises(ValueError):
        contenders(frame_of(spark, []), KEYS, 10, buckets)
