"""Independent jobs run at once."""

from threading import Barrier

import pytest

from dockflow.sources.results import together


def test_actions_overlap_and_keep_local_properties(spark):
    both, seen = Barrier(2, timeout=30), []
    context = spark.sparkContext
    context.setLocalProperty("spark.scheduler.pool", "reports")

    def action():
        both.wait()  # passes only if the other one runs as well
        seen.append((context.getLocalProperty("spark.scheduler.pool"), spark.range(10).count()))

    try:
        together(spark, [action, action])
    finally:
        context.setLocalProperty("spark.scheduler.pool", None)
    assert seen == [("reports", 10)] * 2


def test_an_error_is_raised_when_all_have_ended(spark):
    done = []

    def fails():
        raise ValueError("no result")

    with pytest.raises(ValueError, match="no result"):
        together(spark, [fails, *[lambda i=i: done.append(i) for i in range(5)]], at_once=2)
    assert sorted(done) == [0, 1, 2, 3, 4]
    together(spark, [])
