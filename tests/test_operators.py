"""Operators against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from dockflow.operators.box import box_statistics
from dockflow.operators.flows import station_flows
from dockflow.operators.quantiles import ranked_profile, second_profile, wide_quantiles
from dockflow.operators.ranking import by_name, top_per_group
from dockflow.operators.shares import scaled
from tests.hand import C, M, trips

POINTS = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}


def interpolated(values, p):
    values = sorted(values)
    place = p * (len(values) - 1)
    low = int(place)
    high = min(low + 1, len(values) - 1)
    return values[low] + (place - low) * (values[high] - values[low])


def durations(seed):
    """Micros per group: one value, a hot value, spread fractions, a group without name."""
    rng = random.Random(seed)
    groups = {
        "one": [1_234_567],
        "hot": [5_000_001] * 400 + [rng.randrange(1, 9_000_000) for _ in range(100)],
        "wide": [rng.randrange(1, 900_000 * 10**6) for _ in range(700)] + [252 * 10**15],
        None: [rng.randrange(1, 3_000_000) for _ in range(301)],
    }
    rows = [(group, value) for group, values in groups.items() for value in values]
    rng.shuffle(rows)
    return groups, rows


@pytest.mark.parametrize("seed", [1, 2])
def test_wide_quantiles(spark, seed):
    groups, rows = durations(seed)
    frame = spark.createDataFrame(rows, "g string, us long").withColumn("n", F.lit(1))
    found = {row.g: row for row in wide_quantiles(frame.repartition(7), ["g"], "us", POINTS).collect()}
    assert set(found) == set(groups)
    for group, values in groups.items():
        for name, p in POINTS.items():
            assert found[group][name] == pytest.approx(interpolated(values, p), rel=1e-12)


def test_wide_quantiles_without_groups(spark):
    _, rows = durations(3)
    frame = spark.createDataFrame(rows, "g string, us long").withColumn("n", F.lit(1))
    found = wide_quantiles(frame, [], "us", POINTS).first()
    for name, p in POINTS.items():
        assert found[name] == pytest.approx(interpolated([v for _, v in rows], p), rel=1e-12)


@pytest.mark.parametrize("seed", [5, 6])
def test_box_statistics(spark, seed):
    groups, rows = durations(seed)
    groups |= {"two": [1, 10**12], "gap": [10**6] * 30 + [10**11 + i for i in range(30)] + [9 * 10**11]}
    rows += [(g, v) for g in ("two", "gap") for v in groups[g]]
    frame = spark.createDataFrame(rows, "g string, us long").withColumn("n", F.lit(1)).repartition(7)
    found = {row.g: row for row in box_statistics(frame, "g", F.col("us"), 1000).collect()}
    assert set(found) == set(groups)
    for group, values in groups.items():
        q1, median, q3 = (interpolated(values, p) for p in (0.25, 0.5, 0.75))
        reach = 1.5 * (q3 - q1)
        inside = [v for v in values if q1 - reach <= v <= q3 + reach]
        want = [q1, median, q3, min([*inside, q1]), max([*inside, q3])]
        row = found[group]
        assert [row.q1, row.median, row.q3, row.whisker_low, row.whisker_high] == pytest.approx([v / 1000 for v in want], abs=1e-4)
        assert (row.rides, row.fliers) == (len(values), len(values) - len(inside))


def test_profiles_agree_with_plain_aggregates(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.choice([600, rng.randrange(1, 86400)])) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "g string, duration_secs long").withColumn("n", F.lit(1))
    exact = second_profile(frame, ["g"], {"m": 0.5, "q": 0.95})
    plain = frame.groupBy("g").agg(
        F.count("*").alias("rides"),
        F.sum("duration_secs").alias("total_secs"),
        F.percentile("duration_secs", 0.5).alias("m"),
        F.percentile("duration_secs", 0.95).alias("q"),
    )
    assert sorted(map(tuple, exact.collect())) == sorted(map(tuple, plain.collect()))
    for row in ranked_profile(frame, ["g"], {"m": 0.5, "q": 0.95}).collect():
        values = sorted(v for g, v in rows if g == row.g)
        assert row.m == values[-(-len(values) * 50 // 100) - 1]
        assert row.q == values[-(-len(values) * 95 // 100) - 1]


def test_station_flows(spark):
    rng = random.Random(5)
    names = ["A", "B", "C", None]
    rows = [
        (str(i), C, "2023-01-02 08:00:00", "2023-01-02 09:10:00", rng.choice(names), "A", M)
        for i in range(200)
    ]
    flows = station_flows(trips(spark, rows), {"hour": F.col("hour")}, {"hour": F.col("end_hour")})
    found = {(r.hour, r.station): (r.starts, r.ends) for r in flows.collect()}
    expected = {(8, name): (sum(row[4] == name for row in rows), 0) for name in names}
    assert found == expected | {(9, "A"): (0, 200)}


def test_ties_are_settled_by_name(spark):
    rows = [("x", name, 1) for name in "dacb"] + [("y", None, 2), ("y", "z", 2)]
    frame = spark.createDataFrame(rows, "g string, name string, v int").repartition(5)
    best = top_per_group(frame, ["g"], 2, F.desc("v"), *by_name("name"))
    assert sorted((r.g, r["rank"], r.name) for r in best.collect()) == [
        ("x", 1, "a"),
        ("x", 2, "b"),
        ("y", 1, "z"),
        ("y", 2, None),
    ]


def test_scaled(spark):
    frame = spark.createDataFrame([(10,), (20,), (30,)], "v int")
    assert sorted(r.s for r in frame.select(scaled("v", 5, 30).alias("s")).collect()) == [5, 17.5, 30]
    alone = spark.createDataFrame([(10,)], "v int").select(scaled("v", 5, 30).alias("s"))
    assert alone.first().s is None
