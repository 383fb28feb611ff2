"""Cells and sketches kept with the table, so that documents follow the loads.

What is kept of a load never changes, as a load's rows don't: the cells of the loads that are new
are counted from those loads' rows alone and kept as one batch. All cell measures are sums, so the
union of the batches is as good as cells of the whole table; sketches are merged on reading.

A batch names its loads, and for each the files of it that do not count (see the table). One whose
loads have changed in that, or that overlaps with another, is left aside, and its loads counted
again. Batches are entered once they are complete, so several writers may keep at once. When there
are many, they are merged into one, from the cells and not from the trips.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions.trip import with_calendar
from dockflow.plans.cells import CELLS
from dockflow.plans.durations import merged_sketches, period_sketches
from dockflow.plans.reports import runner, write_documents
from dockflow.sources.claims import claim, create_once, numbers
from dockflow.sources.results import together
from dockflow.sources.table import generation_folder, load_states, read_loads, read_trips

MEASURES = ("n", "total_secs", "total_us")
SKETCHES = "sketches"
BATCH = "load long, state string"
#: More batches than this are merged.
MOST_BATCHES = 100

#: Each kind that is kept, and how it is counted from trips.
KEPT = {kind: count for kind, (count, _) in CELLS.items()} | {SKETCHES: period_sketches}


def _merged(kind: str, rows: DataFrame) -> DataFrame:
    if kind == SKETCHES:
        return merged_sketches(rows)
    measures = [name for name in MEASURES if name in rows.columns]
    grain = [name for name in rows.columns if name not in measures]
    kinds = dict(rows.dtypes)
    return rows.groupBy(*grain).agg(*[F.sum(m).cast(kinds[m]).alias(m) for m in measures])


def _usable(spark: SparkSession, folder: str, states: Mapping[int, str]) -> dict[int, set[int]]:
    """The batches that together hold each load at most once, as they are now; large ones first."""
    known = numbers(spark, f"{folder}/_kept/_done")
    held: dict[int, dict[int, str]] = {}
    if known:
        paths = [f"{folder}/_kept/batches/{n}" for n in known]
        for row in spark.read.schema(f"{BATCH}, batch long").parquet(*paths).collect():
            held.setdefault(row.batch, {})[row.load] = row.state
    used: dict[int, set[int]] = {}
    taken: set[int] = set()
    for batch, loads in sorted(held.items(), key=lambda b: (-len(b[1]), b[0])):
        if not taken & set(loads) and all(states.get(n) == state for n, state in loads.items()):
            used[batch] = set(loads)
            taken |= set(loads)
    return used


def _enter(spark: SparkSession, folder: str, frames: Mapping[str, DataFrame], states: Mapping[int, str]) -> int:
    batch = claim(spark, f"{folder}/_kept/_claims")

    def write(kind: str) -> None:
        frames[kind].write.mode("overwrite").parquet(f"{folder}/_kept/{kind}/{batch}")

    together(spark, [partial(write, kind) for kind in frames])
    named = spark.createDataFrame([(n, state, batch) for n, state in states.items()], f"{BATCH}, batch long")
    named.coalesce(1).write.mode("overwrite").parquet(f"{folder}/_kept/batches/{batch}")
    create_once(spark, f"{folder}/_kept/_done/{batch}")
    return batch


def _kept(spark: SparkSession, folder: str, kind: str, batches: list[int]) -> DataFrame:
    return spark.read.parquet(*[f"{folder}/_kept/{kind}/{n}" for n in batches])


def keep(spark: SparkSession, table: str, most: int = MOST_BATCHES) -> dict[str, DataFrame]:
    """Count what the table's new loads lack, and return all that is kept, a frame for each kind.

    Only the rows of loads that are in no batch are read.
    """
    folder = generation_folder(spark, table)
    states = load_states(spark, folder)
    used = _usable(spark, folder, states)
    fresh = sorted(set(states) - set().union(*used.values()))
    if fresh or not used:
        rows = with_calendar(read_loads(spark, folder, fresh).drop("load"))
        counted = {kind: count(rows) for kind, count in KEPT.items()}
        used[_enter(spark, folder, counted, {n: states[n] for n in fresh})] = set(fresh)
    if len(used) > most:
        merged = {kind: _merged(kind, _kept(spark, folder, kind, sorted(used))) for kind in KEPT}
        used = {_enter(spark, folder, merged, states): set(states)}
    return {kind: _kept(spark, folder, kind, sorted(used)) for kind in KEPT}


def update_reports(
    spark: SparkSession, table: str, path: str, parameters: Mapping[str, Mapping] | None = None
) -> None:
    """Write all documents below ``path`` as they are after the last load, from kept cells."""
    frames = keep(spark, table)
    run = runner(read_trips(spark, table), {kind: frames[kind] for kind in CELLS}, parameters)
    write_documents(spark, run, path)
