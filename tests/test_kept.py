"""Cells and sketches kept per load: documents follow the loads without a recount."""

import json
import os
from unittest.mock import patch

import pytest
from pyspark.sql import functions as F

from dockflow.plans import kept
from dockflow.plans.cells import CELLS
from dockflow.plans.durations import SPREAD, TYPICAL, duration_by_bike, duration_rollup
from dockflow.plans.kept import SKETCHES, keep, update_reports
from dockflow.plans.reports import DOCUMENTS, write_reports
from dockflow.sources.results import read_result
from dockflow.sources.table import append_load, read_trips, replace_table, table_rows
from dockflow.sources.warehouse import raw_trips
from tests.compare import spark_rows


@pytest.fixture(scope="module")
def parts(spark, small):
    rows = table_rows(raw_trips(spark, small))
    return [rows.filter(F.crc32(F.col("ride_id").cast("binary")) % 3 == i) for i in range(3)]


def read_loads_of(run):
    """The loads that a call reads."""
    real, asked = kept.read_loads, []

    def recorded(spark, folder, loads):
        asked.append(loads)
        return real(spark, folder, loads)

    with patch.object(kept, "read_loads", recorded):
        run()
    return asked


def totals(frames):
    return {kind: spark_rows(kept._merged(kind, frames[kind])) for kind in CELLS}


def test_documents_follow_the_loads(spark, parts, run_dir):
    table, reports, again = (os.path.join(run_dir, n) for n in ("trips", "reports", "again"))
    replace_table(table, parts[0])
    assert read_loads_of(lambda: update_reports(spark, table, reports)) == [[1]]
    append_load(parts[1], table)
    append_load(parts[2], table)
    assert read_loads_of(lambda: update_reports(spark, table, reports)) == [[2, 3]]
    assert read_loads_of(lambda: keep(spark, table)) == []
    write_reports(spark, read_trips(spark, table), again)
    for name in DOCUMENTS:
        found, want = (json.loads(read_result(spark, f"{at}/{name}").toJSON().first()) for at in (reports, again))
        assert found == want, name
    # What is kept is the table, whichever way it was counted; merged batches are the same again.
    frames = keep(spark, table)
    whole = {kind: count(read_trips(spark, table)) for kind, (count, _) in CELLS.items()}
    assert totals(frames) == totals(whole)
    merged = keep(spark, table, most=1)
    assert totals(merged) == totals(whole)
    assert read_loads_of(lambda: keep(spark, table, most=1)) == []
    # A new generation has nothing to do with the cells of the old one.
    replace_table(table, parts[1])
    assert read_loads_of(lambda: keep(spark, table)) == [[1]]


def test_a_batch_that_no_longer_holds_is_counted_again(spark, parts, run_dir):
    table = os.path.join(run_dir, "trips")
    replace_table(table, parts[0], parts[1])
    keep(spark, table)
    real = kept.load_states
    with patch.object(kept, "load_states", lambda *a: real(*a) | {2: "a file that another load has"}):
        assert read_loads_of(lambda: keep(spark, table)) == [[1, 2]]


def test_rolled_up_sketches(spark, parts, run_dir):
    table = os.path.join(run_dir, "trips")
    replace_table(table, *parts)
    keep(spark, table)
    sketches = keep(spark, table)[SKETCHES]
    assert all("_kept/sketches" in name for name in sketches.inputFiles())
    for first, last in ((None, None), ("199901", "199912"), ("200001", "200001")):
        found = {r.rideable_type: r for r in duration_rollup(sketches, first=first, last=last).collect()}
        trips = read_trips(spark, table)
        trips = trips if first is None else trips.filter(F.col("file_period").between(first, last))
        want = {r.rideable_type: r for r in duration_by_bike(trips).collect()}
        assert set(found) == set(want)
        values = trips.filter("is_valid").groupBy("rideable_type").agg(F.array_sort(F.collect_list("duration_secs")).alias("v"))
        for bike, v in values.collect():
            assert (found[bike].rides, found[bike].avg_min) == (want[bike].rides, want[bike].avg_min)
            for name, p in TYPICAL.items():
                low, high = (v[min(len(v) - 1, max(0, int(len(v) * q)))] for q in (p - 0.01, p + 0.01))
                assert low / 60 - 0.1 <= found[bike][f"{name}_min"] <= high / 60 + 0.1
    assert set(TYPICAL.values()) <= set(SPREAD.values())
