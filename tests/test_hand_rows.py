"""Edge cases with answers worked out by hand."""

import pytest
from pyspark.sql import functions as F

from dockflow.functions import trip
from dockflow.plans import (
    circular,
    durations,
    growth,
    long_rides,
    overview,
    peaks,
    recommend,
    routes,
    stations,
    users,
)
from tests.hand import ROWS, C, K, M, records, trips


@pytest.fixture(scope="module")
def hand(spark):
    frame = trips(spark).persist()
    yield frame
    frame.unpersist()


def ids(frame):
    return {row.ride_id for row in frame.select("ride_id").collect()}


def test_populations(hand):
    everything = {row[0] for row in ROWS}
    assert ids(trip.started(hand)) == everything - {"e7"}
    assert ids(trip.bounded(hand)) == everything - {"e7", "e8"}
    assert ids(trip.bounded_named(hand)) == {"e1", "e2", "e3", "e4", "e5", "e6"}
    assert ids(trip.valid(hand)) == {"e1", "e2", "e3", "e9", "e10"}
    assert ids(trip.positive(hand)) == {"e1", "e2", "e3", "e5", "e9", "e10"}


def test_whole_and_fractional_seconds(hand):
    row = hand.filter("ride_id = 'e2'").select("duration_secs", "duration_us").first()
    assert tuple(row) == (2, 1_200_000)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_no_result_depends_on_the_session_zone(spark, zone):
    # 02:30 does not exist in New York on that day.
    rows = [("z", C, "2023-03-12 02:30:00", "2023-03-12 03:10:00", "A", "B", M)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = trips(spark, rows).select("hour", "duration_secs", "month_no", "dow").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (2, 2400, 202303, 7)


def test_calendar(hand):
    row = hand.filter("ride_id = 'e3'").first()
    assert (row.month_no, row.hour, row.end_hour, row.season, row.dow) == (202312, 23, 0, "winter", 7)
    assert row.day_class == "weekend"


def test_arrivals_are_booked_in_the_month_of_the_start(hand):
    found = {
        (r.station, r.year, r.month): r.end_count
        for r in stations.station_ends_monthly(hand).collect()
    }
    assert found[("A", 2023, 12)] == 1
    assert ("A", 2024, 1) not in found


def test_unnamed_stations_meet(spark):
    rows = [
        ("1", C, "2023-01-02 08:00:00", "2023-01-02 08:10:00", None, None, M),
        ("2", C, "2023-01-02 09:00:00", "2023-01-02 09:10:00", None, "B", M),
    ]
    frame = trips(spark, rows)
    assert records(stations.station_alltime_topk(frame)) == [
        {"station": None, "rides": 2, "end_count": 1}
    ]
    assert records(stations.station_month_topk(frame)) == [
        {"ym": "2023-01", "station": None, "start_count": 2, "end_count": 1, "net": -1}
    ]


def test_circular_duration_has_three_labels(hand):
    found = {r.label: r.rides for r in circular.circular_duration(hand).collect()}
    assert found == {"circular": 1, "one_way": 2, "unknown": 2}


def test_circular_rate_counts_unknown_as_not_circular(hand):
    found = {
        r.station: (r.total_rides, r.circular_rides, r.pct_circular)
        for r in circular.circular_top_rate(hand, min_rides=0).collect()
    }
    assert found == {"A": (2, 1, 50.0), "B": (2, 0, 0.0), None: (1, 0, 0.0)}


def test_route_counts(hand):
    found = {tuple(r) for r in routes.route_counts(hand).collect()}
    assert found == {
        ("A", "B", 5, False),
        ("A", "A", 1, True),
        ("B", "A", 1, False),
        (None, "B", 1, None),
        ("B", None, 1, None),
    }


def test_asymmetric_routes_come_in_both_directions(hand):
    found = [tuple(r) for r in routes.asymmetric_routes(hand, min_rides=0).collect()]
    assert found == [("A", "B", 5, 1, 83.3), ("B", "A", 1, 5, 16.7)]
    assert routes.asymmetric_routes(hand, min_rides=1).count() == 0


def test_year_over_year(hand):
    found = {
        r.month: (r.rides_base, r.rides_cmp, r.change_pct)
        for r in growth.yoy_monthly(hand).collect()
    }
    expected = {month: (0, 0, None) for month in range(1, 13)}
    expected |= {1: (2, 0, -100.0), 12: (1, 0, -100.0), 6: (0, 2, None)}
    expected |= {month: (0, 1, None) for month in (2, 3, 9, 11)}
    assert found == expected
    assert tuple(growth.yoy_totals(hand).first()) == (3, 6, 100.0)
    assert tuple(growth.yoy_totals(hand, 1900, 1901).first()) == (0, 0, None)


def test_net_inflow(hand):
    found = {
        (r.hour, r.station): (r.score, r.starts + r.ends)
        for r in recommend.station_net_inflow(hand, min_activity=0).collect()
    }
    assert found == {
        (0, "A"): (1, 1),
        (8, "A"): (-1, 1),
        (8, "B"): (1, 1),
        (9, "A"): (0, 2),
        (9, "B"): (1, 1),
        (10, "A"): (-1, 1),
        (12, "A"): (-2, 2),
        (12, "B"): (2, 2),
        (23, "B"): (-1, 1),
    }


def test_recommendation_at_an_hour(hand):
    found = records(recommend.recommend_at(hand, 8, min_activity=0))
    assert [(r["rank"], r["station"], r["outlook"]) for r in found] == [
        (1, "B", "accumulate"),
        (2, "A", "scarce"),
    ]
    for hour in (-1, 24):
        with pytest.raises(ValueError):
            recommend.recommend_at(hand, hour)


def test_axes_are_complete(hand):
    assert [r.hour for r in peaks.peak_hour_table(hand).orderBy("hour").collect()] == list(range(24))
    week = users.user_day_pivot(hand).orderBy("dow").collect()
    assert [r.day for r in week] == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert [(r.member, r.casual) for r in week][1:5] == [(1, 0), (0, 0), (0, 0), (0, 0)]


def test_any_user_type_is_reported(spark):
    rows = [*ROWS, ("x", C, "2023-01-02 08:00:00", "2023-01-02 08:10:00", "A", "B", "guest")]
    found = {r.member_casual for r in users.user_overall(trips(spark, rows)).collect()}
    assert found == {M, K, "guest"}


def test_empty_input(spark):
    empty = trips(spark).filter("ride_id = 'none'")
    assert all(value is None for value in durations.duration_percentiles(empty).first())
    assert overview.overview_duration(empty).first().median_min is None
    assert durations.duration_describe(empty).first()["count"] == 0
    assert durations.duration_histogram(empty).count() == 0
    assert routes.top_routes_geo(empty).count() == 0
    assert circular.circular_overall(empty).first().pct_circular is None
    assert len(growth.yoy_monthly(empty).collect()) == 12


def test_load_profile(hand):
    assert overview.load_profile(hand).first().asDict() == {
        "rows_loaded": 10,
        "bad_start": 1,
        "bad_end": 1,
        "bad_duration": 3,
        "no_start_station": 1,
        "no_end_station": 1,
    }


def test_rounding_is_half_up(spark):
    from dockflow.functions.figures import change_percent, percent, seconds_as_minutes

    row = spark.range(1).select(
        percent(F.lit(49), F.lit(400)).alias("a"),  # 12.25
        percent(F.lit(201), F.lit(20000), 2).alias("b"),  # 1.005
        change_percent(F.lit(400), F.lit(351)).alias("c"),  # -12.25
        seconds_as_minutes(F.lit(909.0)).alias("d"),  # 15.15
        percent(F.lit(1), F.lit(0)).alias("e"),
    ).first()
    assert tuple(row) == (12.3, 1.01, -12.3, 15.2, None)


def test_histogram_edges(spark):
    def ride(i, minutes):
        end = f"2023-01-02 {8 + minutes // 60:02d}:{minutes % 60:02d}:00"
        return (str(i), C, "2023-01-02 08:00:00", end, "A", "A", M)

    frame = trips(spark, [ride(i, m) for i, m in enumerate((10, 20, 30, 50, 90, 200))])
    bins = durations.duration_histogram(frame, bins=4, cap=90).orderBy("bin").collect()
    assert [tuple(b) for b in bins] == [
        (1, 10.0, 30.0, 2),
        (2, 30.0, 50.0, 1),
        (3, 50.0, 70.0, 1),
        (4, 70.0, 90.0, 2),
    ]
    fixed = circular.circular_histogram(frame, bins=3, upto=90).orderBy("bin").collect()
    assert [(b.bin, b.rides) for b in fixed] == [(1, 2), (2, 2), (3, 1)]
    # A single value lies in the middle of a range of one unit.
    alone = durations.duration_histogram(frame.filter("ride_id = '0'"), bins=4).collect()
    assert [(b.bin, b.low, b.rides) for b in sorted(alone)] == [(1, 9.5, 0), (2, 9.75, 0), (3, 10.0, 1), (4, 10.25, 0)]
    # Every bin of every label that occurs, also of one whose rides all lie outside.
    far = circular.circular_histogram(trips(spark, [ride(1, 200)]), bins=3, upto=90).collect()
    assert sorted((b.label, b.bin, b.rides) for b in far) == [("circular", b, 0) for b in (1, 2, 3)]


def test_other_user_types_are_not_lost(spark):
    rows = [*ROWS, *((f"x{i}", C, "2023-01-02 08:00:00", "2023-01-02 08:10:00", "A", "B", u) for i, u in enumerate(("guest", None)))]
    frame = trips(spark, rows).withColumn("file_period", F.lit("202301"))
    assert sum(r.other for r in users.user_day_pivot(frame).collect()) == 2
    assert sum(r.other for r in users.user_hour_pivot(frame).collect()) == 2
    same = {r.category: r.rides_base for r in growth.yoy_same_month(frame, "202301", "202401").collect()}
    assert same == {"total": 12, "member": 7, "casual": 3, "other": 2}


def test_no_user_type_is_in_no_share(spark):
    rows = [(f"x{i}", C, "2023-01-02 08:00:00", "2023-01-02 08:10:00", "A", "A", u) for i, u in enumerate((M, M, K, None))]
    frame = trips(spark, rows)
    for query, name in ((long_rides.user_share, "pct"), (circular.circular_user_share, "circular_pct"), (circular.circular_user_share, "overall_pct")):
        assert {r.member_casual: r[name] for r in query(frame).collect()} == {M: 66.7, K: 33.3}
    assert {r.value: r.pct for r in overview.overview_mix(frame).collect() if r.dimension == "user"} == {M: 66.7, K: 33.3}
