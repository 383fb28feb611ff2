"""Trip files, the trip table, incremental loads and result files."""

import os
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier
from unittest.mock import patch

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import PARAMETERS
from dockflow.functions.trip import prepare
from dockflow.plans.catalog import QUERIES
from dockflow.plans.cells import CELLS
from dockflow.plans.reports import DOCUMENTS, SECTIONS, runner, write_reports
from dockflow.sources import table as table_module
from dockflow.sources.claims import claim, numbers
from dockflow.sources.files import list_trip_files, rejected_rows, scan_trip_files
from dockflow.sources.results import read_result, write_result
from dockflow.sources.schema import TRIP_FILE
from dockflow.sources.table import (
    generation_folder, manifest, next_load, read_trips, rejects, replace_table, table_figures, table_rows, write_trips,
)
from dockflow.sources.warehouse import raw_trips
from dockflow.streaming import incremental
from dockflow.streaming.incremental import load_new_files, load_plan, reload_all_files
from tests.compare import spark_rows
from tests.hand import ROWS, raw

HEADER = ",".join(TRIP_FILE.names)


def line(row):
    ride, bike, start, end, a, b, user = row
    named = [a or "", "7.01" if a else "", b or "", "HB102" if b else ""]
    return ",".join([ride, bike, start, end, *named, "40.5", "-74.0", "", "", user])


def put(folder, name, rows=ROWS, header=HEADER):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as file:
        file.write("\n".join([header, *map(line, rows)]) + "\n")


@pytest.fixture
def files(run_dir):
    folder = os.path.join(run_dir, "csv")
    put(folder, "202301-tripdata_1.csv", ROWS[:2])
    put(folder, "202401-tripdata_1.csv", ROWS[2:5])
    put(folder, "deeper/202401-tripdata_2.csv", ROWS[5:])
    # None of these belongs to the data set.
    put(folder, "JC-202301-tripdata.csv")
    put(folder, "._202301-tripdata_1.csv")
    put(folder, "__MACOSX/202301-tripdata_1.csv")
    put(folder, "notes.txt")
    put(folder, ".DS_Store")
    return folder


def test_only_wanted_files_are_read(spark, files):
    found = scan_trip_files(spark, files)
    counts = {tuple(r) for r in found.groupBy("file_name", "file_period").count().collect()}
    assert counts == {
        ("202301-tripdata_1.csv", "202301", 2),
        ("202401-tripdata_1.csv", "202401", 3),
        ("202401-tripdata_2.csv", "202401", 5),
    }
    listed = {r.file_name for r in list_trip_files(spark, files).collect()}
    assert listed == {name for name, _, _ in counts}


def test_scan_keeps_text_and_prunes_columns(spark, files):
    row = scan_trip_files(spark, files).filter("ride_id = 'e1'").first()
    assert (row.start_station_id, row.end_station_id, row.end_lat) == ("7.01", "HB102", None)
    narrow = scan_trip_files(spark, files, ["started_at", "ended_at"])
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<started_at:string,ended_at:string>" in plan
    assert narrow.count() == 10


def test_headers_are_read_by_name(spark, run_dir):
    put(run_dir, "202301-tripdata_1.csv")
    names = HEADER.split(",")
    turned = [*reversed(names), "extra", "ride_id"]
    path = os.path.join(run_dir, "202302-tripdata_1.csv")
    with open(path, "w") as file:
        file.write("\ufeff" + ",".join(f'"{n.upper()}"' for n in turned) + "\n")
        for row in ROWS:
            file.write(",".join([*reversed(line(row).split(",")), "more", "other id"]) + "\n")
    columns = [F.col(n) for n in TRIP_FILE.names]
    by_period = {p: scan_trip_files(spark, run_dir).filter(F.col("file_period") == p).select(*columns) for p in ("202301", "202302")}
    assert spark_rows(by_period["202301"]) == spark_rows(by_period["202302"])
    narrow = scan_trip_files(spark, run_dir, ["started_at"]).groupBy("started_at").count()
    assert all(n % 2 == 0 for _, n in narrow.collect())


def test_files_give_the_same_answers(spark, run_dir, small):
    view = raw_trips(spark, small)
    out = os.path.join(run_dir, "csv")
    parts = os.path.join(run_dir, "parts")
    view.select(*TRIP_FILE.names, "file_period").repartition(4).write.partitionBy(
        "file_period"
    ).option("header", True).csv(parts)
    # One file per period, named as the publisher names them.
    os.makedirs(out)
    for period in os.listdir(parts):
        if "=" in period:
            month = period.split("=")[1]
            for i, name in enumerate(sorted(os.listdir(os.path.join(parts, period)))):
                if name.endswith(".csv"):
                    os.link(
                        os.path.join(parts, period, name),
                        os.path.join(out, f"{month}-tripdata_{i}.csv"),
                    )
    read = prepare(scan_trip_files(spark, out))
    direct = prepare(view)
    for name in ("bike_type_at_periods", "station_alltime_topk", "circular_duration", "load_profile"):
        parameters = PARAMETERS.get(name, {})
        assert spark_rows(QUERIES[name](read, **parameters)) == spark_rows(
            QUERIES[name](direct, **parameters)
        )


@pytest.fixture(scope="module")
def table(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("table"))
    write_trips(raw_trips(spark, small), path)
    return path


def test_table_gives_the_same_answers(spark, table, small):
    stored, direct = read_trips(spark, table), prepare(raw_trips(spark, small))
    for name in ("load_profile", "station_month_topk", "duration_box_by_bike", "yoy_same_month"):
        parameters = PARAMETERS.get(name, {})
        assert spark_rows(QUERIES[name](stored, **parameters)) == spark_rows(
            QUERIES[name](direct, **parameters)
        )


def test_table_is_gathered_and_pruned(spark, table):
    stored = read_trips(spark, table)
    # One file a partition: few large files, not one per task and month.
    parts = stored.select("file_period", "year", "month").distinct().count()
    assert len(spark.read.parquet(table).inputFiles()) <= parts + 1
    plan = QUERIES["yoy_totals"](stored, 1999, 2000)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year#" in plan or "PartitionFilters: [year#" in plan
    # Answered by the partition names and the number of rows.
    assert "ReadSchema: struct<>" in plan
    plan = QUERIES["peak_hours_simple"](stored)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<dow:int,hour:int>" in plan


def test_table_from_files(spark, files, run_dir):
    path = os.path.join(run_dir, "trips")
    write_trips(scan_trip_files(spark, files), path, gather=False)
    stored = read_trips(spark, path)
    assert spark_rows(QUERIES["load_profile"](stored)) == spark_rows(
        QUERIES["load_profile"](prepare(raw(spark)))
    )
    # The ride without a readable start is kept, in a partition of its own.
    assert [r.ride_id for r in stored.filter("month is null").collect()] == ["e7"]


@pytest.fixture(scope="module")
def cells(spark, table, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cells"))
    for kind, (count, _) in CELLS.items():
        count(read_trips(spark, table)).write.parquet(f"{path}/{kind}")
    return {kind: spark.read.parquet(f"{path}/{kind}") for kind in CELLS}


@pytest.mark.parametrize(("kind", "name"), [(kind, name) for kind in CELLS for name in sorted(CELLS[kind][1])])
def test_cells_give_the_same_answers(spark, table, cells, kind, name):
    parameters = PARAMETERS.get(name, {})
    assert spark_rows(SECTIONS[name](cells[kind], **parameters)) == spark_rows(
        SECTIONS[name](read_trips(spark, table), **parameters)
    )


def test_documents_read_the_trips_once_per_kind_of_cell(spark, table, cells):
    run = runner(read_trips(spark, table), cells)
    asked = []

    def recorded(name):
        frame = run(name)
        asked.append((name, frame.inputFiles()))
        return frame

    for build in DOCUMENTS.values():
        build(recorded)
    assert len(asked) > 30
    assert [name for name, used in asked if any("/cells" not in path for path in used)] == []


def test_incremental_load(spark, files, run_dir):
    table = os.path.join(run_dir, "trips")

    def plan():
        return {r.file_name: r.status for r in load_plan(spark, files, table).collect()}

    assert set(plan().values()) == {"new"}
    load_new_files(spark, files, table, files_per_load=2)
    assert set(plan().values()) == {"skipped"}
    assert read_trips(spark, table).count() == 10

    put(files, "202402-tripdata_1.csv", ROWS[:1])
    # Known by its name, wherever it lies.
    put(files, "again/202301-tripdata_1.csv", ROWS)
    assert [name for name, status in plan().items() if status == "new"] == ["202402-tripdata_1.csv"]
    load_new_files(spark, files, table)
    load_new_files(spark, files, table)
    stored = read_trips(spark, table)
    assert stored.count() == 11
    assert stored.filter("file_period = '202402'").count() == 1
    assert stored.filter("year = 2023").count() == 4


def test_load_loses_nothing(spark, files, run_dir):
    table = os.path.join(run_dir, "trips")
    count = lambda: read_trips(spark, table).count()
    assert count() == 0
    write_trips(scan_trip_files(spark, files), table, gather=False)
    assert count() == 10
    # Much older than the newest file.
    put(files, "201901-tripdata.csv", ROWS[:2])
    (old,) = [os.path.join(d, f) for d, _, names in os.walk(files) for f in names if f.startswith("201901")]
    os.utime(old, (0, 0))
    load_new_files(spark, files, table)
    assert count() == 12
    write_trips(scan_trip_files(spark, old), table, mode="append")
    assert count() == 14
    # One name in two folders of one run: the first path counts. A header alone is a file as well.
    put(files, "a/202405-tripdata.csv", ROWS[:1])
    put(files, "b/202405-tripdata.csv", ROWS[:3])
    put(files, "202406-tripdata.csv", [])
    plan = {(r.path.split("/")[-2], r.file_name): r.status for r in load_plan(spark, files, table).collect()}
    assert (plan["a", "202405-tripdata.csv"], plan["b", "202405-tripdata.csv"]) == ("new", "repeated")
    load_new_files(spark, files, table)
    assert count() == 15
    assert {r.status for r in load_plan(spark, files, table).collect()} == {"skipped"}
    # A run that died before the manifest: its rows aren't seen.
    put(files, "202407-tripdata.csv", ROWS[:1])
    load = next_load(spark, table)
    folder = generation_folder(spark, table)
    table_rows(scan_trip_files(spark, old)).write.partitionBy("year", "month").parquet(f"{folder}/load={load}")
    assert count() == 15
    load_new_files(spark, files, table)
    assert count() == 16 and next_load(spark, table) == load + 1
    # The same, but its writer had claimed a number: nobody else takes it.
    assert claim(spark, f"{folder}/_claims/load") == load + 1
    put(files, "202408-tripdata.csv", ROWS[:1])
    load_new_files(spark, files, table)
    assert count() == 17 and next_load(spark, table) == load + 3


def test_claims_are_exclusive(spark, run_dir):
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: claim(spark, f"{run_dir}/claims"), range(40)))
    assert sorted(got) == list(range(1, 41)) == numbers(spark, f"{run_dir}/claims")
    assert claim(spark, f"{run_dir}/claims", 100) == 100
    assert numbers(spark, f"{run_dir}/none") == []


def test_loads_at_the_same_time_lose_and_double_nothing(spark, run_dir):
    """Each of two loads has planned, and takes one file of its own and one that both see, before either writes."""
    csv, table = os.path.join(run_dir, "csv"), os.path.join(run_dir, "trips")
    put(csv, "a/202301-tripdata.csv", ROWS[:2])
    put(csv, "b/202302-tripdata.csv", ROWS[:3])
    put(csv, "b/202301-tripdata.csv", ROWS[:2])
    planned = Barrier(2)
    real = incremental.checked_rows

    def together(*args):
        planned.wait(120)
        return real(*args)

    with patch.object(incremental, "checked_rows", together), ThreadPoolExecutor(2) as pool:
        done = [pool.submit(load_new_files, spark, f"{csv}/{folder}", table) for folder in "ab"]
        assert [d.result(300) for d in done] == [None, None]
    stored = read_trips(spark, table)
    assert {tuple(r) for r in stored.groupBy("file_name").count().collect()} == {("202301-tripdata.csv", 2), ("202302-tripdata.csv", 3)}
    assert table_figures(spark, table).first().rows_loaded == 5 == stored.count()
    assert {r.status for r in load_plan(spark, csv, table).filter("status <> 'repeated'").collect()} == {"skipped"}
    load_new_files(spark, csv, table)
    assert read_trips(spark, table).count() == 5


def test_a_replacement_that_dies_leaves_the_old_table(spark, files, run_dir):
    table = os.path.join(run_dir, "trips")
    write_trips(scan_trip_files(spark, files), table, gather=False)
    before = spark_rows(QUERIES["load_profile"](read_trips(spark, table)))
    broken = scan_trip_files(spark, files).withColumn("ride_id", F.when(F.col("ride_id") == "e7", F.raise_error(F.lit("lost"))).otherwise(F.col("ride_id")))
    with pytest.raises(Exception, match="lost"):
        write_trips(broken, table, gather=False)
    with patch.object(table_module, "publish", side_effect=RuntimeError("dies before it is published")), pytest.raises(RuntimeError):
        write_trips(scan_trip_files(spark, files), table, gather=False)
    assert spark_rows(QUERIES["load_profile"](read_trips(spark, table))) == before
    # A reader that began before the replacement goes on with the old rows.
    reading = read_trips(spark, table)
    put(files, "202409-tripdata.csv", ROWS[:1])
    reload_all_files(spark, files, table, files_per_load=2)
    assert (reading.count(), read_trips(spark, table).count()) == (10, 11)
    assert {r.status for r in load_plan(spark, files, table).collect()} == {"skipped"}


def test_a_load_into_a_replaced_table_is_written_again(spark, files, run_dir):
    table = os.path.join(run_dir, "trips")
    load_new_files(spark, files, table)
    put(files, "202409-tripdata.csv", ROWS[:1])
    real = table_module.write_to

    def overtaken(folder, rows, *how):
        if folder == table:
            replace_table(table, table_rows(scan_trip_files(spark, os.path.join(files, "deeper"))).limit(3))
        return real(folder, rows, *how)

    with patch.object(table_module, "write_to", overtaken):
        load_new_files(spark, files, table)
    assert read_trips(spark, table).count() == 4


def test_rejects(spark, run_dir):
    csv, table = os.path.join(run_dir, "csv"), os.path.join(run_dir, "trips")
    put(csv, "202301-tripdata.csv", ROWS[:4])
    put(csv, "202302-tripdata.csv", ROWS[:3])
    put(csv, "202303-tripdata.csv", ROWS[:2], header="one,two,started_at")
    open(os.path.join(csv, "202304-tripdata.csv"), "w").close()
    with open(os.path.join(csv, "202302-tripdata.csv"), "a") as file:
        file.write('s1,classic_bike,"2024-01-01 08:00:00",2024\n' + line(ROWS[0]) + ",more\n" + '"x,y",short "",too\n')
    load_new_files(spark, csv, table)
    assert read_trips(spark, table).count() == 7
    bad = sorted((r.file_name, r.fault, r.row) for r in rejects(spark, table).collect())
    assert [b[:2] for b in bad] == [("202302-tripdata.csv", "long"), ("202302-tripdata.csv", "short"), ("202302-tripdata.csv", "short"), ("202303-tripdata.csv", "header")]
    assert bad[0][2] == line(ROWS[0]) + ",more" and bad[3][2] == "one,two,started_at"
    assert sorted((r.file_name, r.rows, r.rejected) for r in manifest(spark, table).collect()) == [
        ("202301-tripdata.csv", 4, 0), ("202302-tripdata.csv", 3, 3), ("202303-tripdata.csv", 0, 1)]  # Spark lists no empty files
    assert scan_trip_files(spark, csv).count() == 7 and rejected_rows(spark, csv).count() == 4
    # Good files alone: nothing is parsed twice, and there are no rejects.
    good = os.path.join(run_dir, "good")
    load_new_files(spark, os.path.join(csv, "202301-tripdata.csv"), good)
    assert rejects(spark, good).count() == 0 and not os.path.exists(f"{good}/_rejects")


def test_figures_read_no_trips(spark, files, run_dir):
    table = os.path.join(run_dir, "trips")
    assert table_figures(spark, table).first().asDict() == {"rows_loaded": 0, "rows_rejected": 0, "files": 0, "first_start": None, "last_start": None, "latest_month": None}
    load_new_files(spark, files, table, files_per_load=1)
    trips, figures = read_trips(spark, table), table_figures(spark, table)
    assert all("/_entries/" in name for name in figures.inputFiles())
    found = figures.first()
    want = trips.agg(F.count(F.lit(1)), F.min("started_at"), F.max("started_at"), F.max("month_no")).first()
    assert (found.rows_loaded, found.first_start, found.last_start, found.latest_month) == tuple(want)
    assert (found.files, found.rows_rejected) == (3, 0)


def test_no_overflow(spark):
    """Rows that stand for many rides, sums beyond BIGINT, and rides that end in 9999."""
    frame = prepare(raw(spark)).withColumns({"n": F.lit(10**12), "total_us": F.col("duration_us") * 10**8})
    frame = frame.union(frame)
    for name in ("user_avg_duration", "overview_duration", "duration_describe", "long_ride_describe", "duration_box_by_bike", "circular_box"):
        QUERIES[name](frame).collect()
    last = raw(spark).withColumn("ended_at", F.lit("9999-12-31 00:00:00"))
    for name in ("long_ride_histogram", "duration_histogram", "user_avg_duration", "overview_duration", "duration_describe", "long_ride_describe", "duration_box_by_bike"):
        QUERIES[name](prepare(last)).collect()


def test_results(spark, run_dir):
    path = os.path.join(run_dir, "result")
    with pytest.raises(FileNotFoundError):
        read_result(spark, path)
    write_result(spark.range(3), path)
    write_result(spark.range(2), path)
    assert sorted(r.id for r in read_result(spark, path).collect()) == [0, 1]


def test_documents(spark, run_dir):
    trips = prepare(raw(spark)).withColumn("file_period", F.col("month_no").cast("string"))
    low = {
        "asymmetric_routes": {"min_rides": 0},
        "circular_top_rate": {"min_rides": 0},
        "recommend_best": {"min_activity": 0},
        "recommend_top5": {"min_activity": 0},
    }
    write_reports(spark, trips, run_dir, low)
    read = {
        name: read_result(spark, f"{run_dir}/{name}").first().asDict(recursive=True)
        for name in DOCUMENTS
    }
    assert len(read) == 11
    month = read["popular_stations"]["by_month"]["2024-06"]
    assert [(s.get("station_name"), s["start_count"], s["net"]) for s in month] == [
        ("A", 1, -1),
        (None, 1, -1),
    ]
    assert read["yoy_growth"]["yearly_totals"] == {"rides_base": 3, "rides_cmp": 6, "growth_pct": 100.0}
    assert [m["month"] for m in read["yoy_growth"]["monthly"]] == list(range(1, 13))
    assert read["top_routes"]["asymmetric_routes"][0]["asymmetry_pct"] == 83.3
    assert read["recommendations"]["by_hour"]["8"]["station"] == "B"
    assert [s["station"] for s in read["recommendations_top5"]["by_hour"]["8"]] == ["B", "A"]
    assert read["seasonal_impact"]["yoy_by_season"]["2023"] == {"winter": 3}
    assert read["circular_trips"]["overall"]["circular_rides"] == 1
    assert read["peak_hours"]["by_season"]["weekday"]["winter"] == [
        {"hour": 8, "rides": 1},
        {"hour": 12, "rides": 1},
    ]
    assert [d["day"] for d in read["user_patterns"]["by_day"]["member"]] == ["Monday", "Tuesday", "Sunday"]
    assert read["trip_durations"]["overall_percentiles_min"]["p50"] == 20.0
    assert len(read["bike_type_trends"]["monthly_summary"]) == 7
