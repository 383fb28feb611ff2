"""One SQL text per query, at the parameters the test tables call for."""

from __future__ import annotations

from oracle.trips import TRIPS, as_min, mean_min, pct, signed_pct

N = "CAST(count(*) AS BIGINT)"


def total(column: str) -> str:
    return f"CAST(sum({column}) AS BIGINT)"


def json_object(key: str, value: str) -> str:
    """Aggregate: a JSON object of counts, in key order."""
    return f"""'{{' || string_agg('"' || {key} || '":' || {value}, ',' ORDER BY {key}) || '}}'"""


def where(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


MONTH_NAMES = (
    "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
)
DAYS = "['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']"

STARTS = f"""starts AS (SELECT start_station_name AS station, year, month, ym, {N} AS start_count
  FROM bounded GROUP BY start_station_name, year, month, ym)"""
ENDS = f"""ends AS (SELECT end_station_name AS station, year, month, ym, {N} AS end_count
  FROM bounded GROUP BY end_station_name, year, month, ym)"""
MONTH_TOP = f"""{STARTS}, {ENDS}, month_top AS (
  SELECT s.ym, s.station, s.start_count, CAST(coalesce(e.end_count, 0) AS BIGINT) AS end_count,
    CAST(coalesce(e.end_count, 0) - s.start_count AS BIGINT) AS net,
    row_number() OVER (PARTITION BY s.ym ORDER BY s.start_count DESC, s.station NULLS LAST) AS rn
  FROM starts s LEFT JOIN ends e
    ON s.ym = e.ym AND s.station IS NOT DISTINCT FROM e.station)"""

INFLOW = f"""s AS (SELECT hour, start_station_name AS station, {N} AS starts
  FROM bounded_named GROUP BY hour, start_station_name),
e AS (SELECT end_hour AS hour, end_station_name AS station, {N} AS ends
  FROM bounded_named GROUP BY end_hour, end_station_name),
inflow AS (SELECT coalesce(s.hour, e.hour) AS hour, coalesce(s.station, e.station) AS station,
    CAST(coalesce(starts, 0) AS BIGINT) AS starts, CAST(coalesce(ends, 0) AS BIGINT) AS ends,
    CAST(coalesce(ends, 0) - coalesce(starts, 0) AS BIGINT) AS score
  FROM s FULL OUTER JOIN e ON s.hour = e.hour AND s.station = e.station
  WHERE coalesce(starts, 0) + coalesce(ends, 0) > 200),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY hour ORDER BY score DESC, station) AS BIGINT)
  AS rank FROM inflow)"""

LONG = "long_rides AS (SELECT * FROM positive WHERE us > 2700000000)"


def describe(source: str, unit: int) -> str:
    def part(expression: str, name: str) -> str:
        return f"round({expression}, 6) AS {name}"

    value = f"us / {unit}.0::DOUBLE"
    return f"""SELECT {N} AS count, {part(f"sum(us)::DOUBLE / (count(*) * {unit})", "mean")},
      {part(f"stddev_samp({value})", "std")}, {part(f"min({value})", "min")},
      {part(f"quantile_cont(us::DOUBLE, 0.25) / {unit}", "p25")},
      {part(f"quantile_cont(us::DOUBLE, 0.5) / {unit}", "p50")},
      {part(f"quantile_cont(us::DOUBLE, 0.75) / {unit}", "p75")}, {part(f"max({value})", "max")}
    FROM {source}"""


def box(label: str, cap: int, condition: str) -> str:
    us = "x / 60000000.0::DOUBLE"
    return f"""capped AS (SELECT {label}, least(us, {cap * 60000000}) AS x FROM positive WHERE {condition}),
    quart AS (SELECT {label}, quantile_cont(x::DOUBLE, 0.25) AS q1, quantile_cont(x::DOUBLE, 0.5) AS q2,
      quantile_cont(x::DOUBLE, 0.75) AS q3 FROM capped GROUP BY {label}),
    fenced AS (SELECT c.{label}, x, q1, q2, q3, x < q1 - 1.5 * (q3 - q1) AS below, x > q3 + 1.5 * (q3 - q1) AS above
      FROM capped c JOIN quart q ON c.{label} = q.{label})
    SELECT {label}, {N} AS rides, round(min(q1) / 60000000, 4) AS q1, round(min(q2) / 60000000, 4) AS median,
      round(min(q3) / 60000000, 4) AS q3,
      round(least(min({us}) FILTER (WHERE NOT below), min(q1) / 60000000), 4) AS whisker_low,
      round(greatest(max({us}) FILTER (WHERE NOT above), max(q3) / 60000000), 4) AS whisker_high,
      {where("below OR above")} AS fliers
    FROM fenced GROUP BY {label}"""


def range_bins(source: str, value: str, bins: int, unit: int) -> str:
    return f"""v AS (SELECT {value} AS x FROM {source}),
    span AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
    binned AS (SELECT CAST(least((x - lo) * {bins} // (hi - lo), {bins - 1}) + 1 AS BIGINT) AS bin, lo, hi
      FROM v, span)
    SELECT CAST(b AS BIGINT) AS bin, (s.lo * {bins} + (b - 1) * (s.hi - s.lo))::DOUBLE / {bins * unit} AS low,
      (s.lo * {bins} + b * (s.hi - s.lo))::DOUBLE / {bins * unit} AS high, CAST(count(binned.bin) AS BIGINT) AS rides
    FROM span s, generate_series(1, {bins}) AS axis(b) LEFT JOIN binned ON binned.bin = b GROUP BY b, s.lo, s.hi"""


def profile(keys: str, quantile: str, source: str = "valid", label: str | None = None) -> str:
    group = f"GROUP BY {keys}"
    return f"""SELECT {label or keys}, {N} AS rides, {mean_min("sum(secs)", "count(*)")} AS avg_min,
      {as_min(f"{quantile}(secs::DOUBLE, 0.5)")} AS median_min,
      {as_min(f"{quantile}(secs::DOUBLE, 0.95)")} AS p95_min FROM {source} {group}"""


def sketched(keys: str, quantiles: dict[str, float], source: str = "valid") -> str:
    """The exact values, and that every sketched value is within its rank error."""
    return " UNION ALL ".join(
        f"""SELECT {keys}, {N} AS rides, '{name}' AS quantile,
      {as_min(f"quantile_disc(secs::DOUBLE, {p})")} AS exact_min, true AS within FROM {source} GROUP BY {keys}"""
        for name, p in quantiles.items()
    )


def scale(low: int, high: int, by: str = "") -> str:
    over = f"OVER ({by})"
    return (
        f"{low} + (rides - min(rides) {over})::DOUBLE / "
        f"(max(rides) {over} - min(rides) {over}) * {high - low}"
    )


# Common table expressions followed by the query, or the query alone.
BODIES = {
    # Stations
    "station_starts_monthly": f"{STARTS} SELECT station, year, month, start_count FROM starts",
    "station_ends_monthly": f"{ENDS} SELECT station, year, month, end_count FROM ends",
    "station_month_topk": f"""{MONTH_TOP}
      SELECT ym, station, start_count, end_count, net FROM month_top WHERE rn <= 20""",
    "station_alltime_topk": f"""s AS (SELECT start_station_name AS station, {N} AS rides
        FROM bounded GROUP BY start_station_name),
      e AS (SELECT end_station_name AS station, {N} AS end_count FROM bounded GROUP BY end_station_name)
      SELECT s.station, rides, CAST(coalesce(end_count, 0) AS BIGINT) AS end_count
      FROM s LEFT JOIN e ON s.station IS NOT DISTINCT FROM e.station
      ORDER BY rides DESC, s.station NULLS LAST LIMIT 30""",
    "station_end_heavy_latest": f"""{MONTH_TOP}
      SELECT ym, station, start_count, end_count, net,
        CASE WHEN net > 0 THEN 'ends > starts' ELSE 'starts > ends' END AS direction
      FROM month_top WHERE rn <= 20 AND ym = (SELECT max(ym) FROM month_top)
      ORDER BY net DESC, start_count DESC, station NULLS LAST LIMIT 5""",
    "station_top_starts_named": f"""SELECT start_station_name AS station, {N} AS rides FROM positive
      WHERE start_station_name IS NOT NULL GROUP BY start_station_name
      ORDER BY rides DESC, station LIMIT 15""",
    "station_map_points": f"""placed AS (SELECT start_station_name AS station, ride_id, start_lat AS y, start_lng AS x,
        row_number() OVER (PARTITION BY start_station_name
          ORDER BY start_lat IS NULL OR start_lng IS NULL, started_at, start_lat, start_lng) AS rn
      FROM positive WHERE start_station_name IS NOT NULL),
      points AS (SELECT station, CAST(count(ride_id) AS BIGINT) AS rides,
        max(CASE WHEN rn = 1 AND x IS NOT NULL THEN y END) AS lat, max(CASE WHEN rn = 1 AND y IS NOT NULL THEN x END) AS lng
      FROM placed GROUP BY station ORDER BY rides DESC, station LIMIT 40)
      SELECT station, rides, lat, lng, {scale(5, 30)} AS radius FROM points""",
    # Bike types
    "bike_type_monthly": f"""SELECT ym, rideable_type, member_casual, {N} AS rides FROM started
      GROUP BY ym, rideable_type, member_casual""",
    "bike_type_monthly_summary": f"""SELECT ym, {N} AS total_rides,
        {where("rideable_type = 'classic_bike'")} AS classic,
        {where("rideable_type = 'electric_bike'")} AS electric,
        {pct("count(*) FILTER (WHERE rideable_type = 'electric_bike')", "count(*)")} AS pct_electric
      FROM started GROUP BY ym""",
    "bike_type_latest_month": f"""SELECT ym, rideable_type, member_casual, {N} AS rides FROM started
      WHERE ym = (SELECT max(ym) FROM started) GROUP BY ym, rideable_type, member_casual""",
    "bike_type_at_periods": f"""c AS (SELECT file_period AS period,
        {where("rideable_type = 'classic_bike'")} AS classic,
        {where("rideable_type = 'electric_bike'")} AS electric
      FROM trips WHERE file_period IN ('199901', '199906', '200001', '200006') GROUP BY file_period)
      SELECT period, classic, electric, {pct("electric", "(classic + electric)")} AS pct_electric FROM c""",
    # User patterns
    "user_hourly": f"""SELECT member_casual, hour, {N} AS rides,
        {mean_min("sum(secs)", "count(*)")} AS avg_duration_min
      FROM valid GROUP BY member_casual, hour""",
    "user_daily": f"""SELECT member_casual, dow, ({DAYS})[dow] AS day, {N} AS rides FROM valid
      GROUP BY member_casual, dow""",
    "user_weekend": f"""SELECT member_casual, is_weekend, {N} AS rides,
        {mean_min("sum(secs)", "count(*)")} AS avg_duration_min
      FROM valid GROUP BY member_casual, is_weekend""",
    "user_overall": f"""SELECT member_casual, {N} AS total_rides,
        {mean_min("sum(secs)", "count(*)")} AS avg_duration_min,
        {as_min("quantile_cont(secs::DOUBLE, 0.5)")} AS median_duration_min
      FROM valid GROUP BY member_casual""",
    "user_day_pivot": f"""SELECT CAST(d AS BIGINT) AS dow, left(({DAYS})[d], 3) AS day,
        {where("member_casual = 'member'")} AS member, {where("member_casual = 'casual'")} AS casual,
        {where("valid.dow IS NOT NULL AND member_casual IS DISTINCT FROM 'member' AND member_casual IS DISTINCT FROM 'casual'")} AS other
      FROM generate_series(1, 7) AS axis(d) LEFT JOIN valid ON valid.dow = d GROUP BY d""",
    "user_hour_pivot": f"""SELECT hour, {where("member_casual = 'member'")} AS member,
        {where("member_casual = 'casual'")} AS casual,
        {where("member_casual IS DISTINCT FROM 'member' AND member_casual IS DISTINCT FROM 'casual'")} AS other
      FROM positive GROUP BY hour""",
    "user_avg_duration": """SELECT member_casual,
        sum(us)::DOUBLE / (count(*) * 60000000) AS avg_duration_min
      FROM positive GROUP BY member_casual""",
    # Peak hours
    "peak_hours_by_season": f"""SELECT hour, is_weekend, season, {N} AS rides FROM started
      GROUP BY hour, is_weekend, season""",
    "peak_hours_nested": f"""h AS (SELECT is_weekend, season, hour, {N} AS rides FROM started
        GROUP BY is_weekend, season, hour)
      SELECT is_weekend, season,
        CAST(to_json(list(struct_pack(hour := hour, rides := rides) ORDER BY hour)) AS VARCHAR) AS hours
      FROM h GROUP BY is_weekend, season""",
    "peak_hours_simple": f"SELECT hour, is_weekend, {N} AS rides FROM started GROUP BY hour, is_weekend",
    "peak_hour_table": f"""SELECT CAST(h AS BIGINT) AS hour, {where("is_weekend = 'weekday'")} AS weekday,
        {where("is_weekend = 'weekend'")} AS weekend
      FROM generate_series(0, 23) AS axis(h) LEFT JOIN started ON started.hour = h GROUP BY h""",
    "season_peak_hour": f"""h AS (SELECT season, hour, {N} AS rides FROM started
        WHERE is_weekend = 'weekday' GROUP BY season, hour),
      r AS (SELECT *, row_number() OVER (PARTITION BY season ORDER BY rides DESC, hour) AS rn,
        sum(rides) OVER (PARTITION BY season) AS total FROM h)
      SELECT season, hour AS peak_hour, rides AS peak_rides, CAST(total AS BIGINT) AS total_rides
      FROM r WHERE rn = 1""",
    "hourly_rides_per_day": """d AS (
        SELECT count(DISTINCT CAST(started_at AS DATE)) FILTER (WHERE is_weekend = 'weekday') AS wd,
          count(DISTINCT CAST(started_at AS DATE)) FILTER (WHERE is_weekend = 'weekend') AS we
        FROM positive)
      SELECT hour, count(*) FILTER (WHERE is_weekend = 'weekday') / wd::DOUBLE AS weekday_per_day,
        count(*) FILTER (WHERE is_weekend = 'weekend') / we::DOUBLE AS weekend_per_day
      FROM positive, d GROUP BY hour, wd, we""",
    # Year over year
    "monthly_rides": f"SELECT year, month, {N} AS rides FROM started GROUP BY year, month",
    "monthly_rides_by_user": f"SELECT ym, member_casual, {N} AS rides FROM started GROUP BY ym, member_casual",
    "monthly_rides_by_user_nested": f"""u AS (SELECT ym, member_casual, {N} AS rides FROM started
        GROUP BY ym, member_casual)
      SELECT ym, {json_object("member_casual", "rides")} AS rides
      FROM u GROUP BY ym""",
    "yoy_monthly": f"""c AS (SELECT CAST(m AS BIGINT) AS month, {where("year = 1999")} AS rides_base,
        {where("year = 2000")} AS rides_cmp
      FROM generate_series(1, 12) AS axis(m) LEFT JOIN started ON started.month = m GROUP BY m)
      SELECT month, ({MONTH_NAMES})[month] AS month_name, rides_base, rides_cmp,
        CASE WHEN rides_base > 0 THEN {signed_pct("(rides_cmp - rides_base)", "rides_base")} END AS change_pct
      FROM c""",
    "yoy_totals": f"""c AS (SELECT {where("year = 1999")} AS rides_base, {where("year = 2000")} AS rides_cmp
      FROM started)
      SELECT rides_base, rides_cmp,
        CASE WHEN rides_base > 0 THEN {signed_pct("(rides_cmp - rides_base)", "rides_base")} END AS growth_pct
      FROM c""",
    "yoy_same_month": f"""g AS (
        SELECT 'total' AS category, file_period FROM trips
        UNION ALL SELECT CASE WHEN member_casual IN ('member', 'casual') THEN member_casual ELSE 'other' END, file_period FROM trips),
      c AS (SELECT k.category, {where("file_period = '199906'")} AS rides_base,
        {where("file_period = '200006'")} AS rides_cmp
        FROM (VALUES ('total'), ('member'), ('casual'), ('other')) AS k(category) LEFT JOIN g ON g.category = k.category GROUP BY k.category)
      SELECT category, rides_base, rides_cmp, CASE WHEN rides_base > 0 AND category = 'total'
        THEN {signed_pct("(rides_cmp - rides_base)", "rides_base")} END AS growth_pct FROM c""",
    "monthly_volume_by_file": f"""m AS (SELECT CAST(substr(file_period, 5, 2) AS BIGINT) AS month
      FROM trips WHERE substr(file_period, 1, 4) = '2000')
      SELECT month, ({MONTH_NAMES})[month] AS month_name, {N} AS rides FROM m GROUP BY month""",
    # Durations
    "duration_by_bike": profile("rideable_type", "quantile_disc"),
    "duration_by_bike_user": profile("rideable_type, member_casual", "quantile_disc"),
    "duration_percentiles": "SELECT "
    + ", ".join(
        f"{as_min(f'quantile_disc(secs::DOUBLE, {p / 100})')} AS p{p}"
        for p in (10, 25, 50, 75, 90, 95, 99)
    )
    + " FROM valid",
    "duration_sketch_by_bike": sketched("rideable_type", {"median": 0.5, "p95": 0.95}),
    "duration_sketch_by_bike_user": sketched(
        "rideable_type, member_casual", {f"p{p}": p / 100 for p in (10, 25, 50, 75, 90, 95, 99)}
    ),
    "duration_sketch_rollup": sketched(
        "rideable_type", {f"p{p}": p / 100 for p in (10, 25, 50, 75, 90, 95, 99)},
        "(SELECT * FROM valid WHERE file_period BETWEEN '199903' AND '200004')",
    ),
    "duration_by_bike_exact": profile("rideable_type", "quantile_cont"),
    "duration_describe": describe("positive", 60000000),
    "duration_histogram": range_bins("positive", "least(us, 7200000000)", 80, 60000000),
    "duration_box_by_bike": box(
        "rideable_type", 120, "rideable_type IN ('classic_bike', 'electric_bike')"
    ),
    # Long rides
    "long_ride_summary": f"""c AS (SELECT {where("us > 2700000000")} AS long_rides, {N} AS all_rides,
        {where("us > 86400000000")} AS over_a_day FROM positive)
      SELECT *, {pct("long_rides", "all_rides", 2)} AS pct_long FROM c""",
    "long_ride_describe": f"{LONG} {describe('long_rides', 1000000)}",
    "long_ride_split": f"""{LONG}
      SELECT 'user' AS dimension, member_casual AS value, {N} AS rides FROM long_rides GROUP BY member_casual
      UNION ALL SELECT 'bike', rideable_type, {N} FROM long_rides GROUP BY rideable_type
      UNION ALL SELECT 'day', ({DAYS})[dow], {N} FROM long_rides GROUP BY dow
      UNION ALL SELECT 'hour', CAST(hour AS VARCHAR), {N} FROM long_rides GROUP BY hour""",
    "user_share": f"""c AS (SELECT member_casual, {N} AS rides FROM positive WHERE member_casual IS NOT NULL GROUP BY member_casual)
      SELECT member_casual, rides, {pct("rides", "(SELECT count(member_casual) FROM positive)")} AS pct FROM c""",
    "long_ride_histogram": f"{LONG}, {range_bins('long_rides', 'us', 40, 3600000000)}",
    "long_ride_rate_by_user": f"""c AS (SELECT member_casual, {where("us > 2700000000")} AS long_rides,
        {N} AS all_rides FROM positive GROUP BY member_casual)
      SELECT *, {pct("long_rides", "all_rides", 2)} AS pct_long FROM c""",
    "long_ride_circular_share": f"""{LONG}, c AS (
        SELECT 'long' AS population, {N} AS rides, {where("is_circular")} AS circular FROM long_rides
        UNION ALL SELECT 'all', {N}, {where("is_circular")} FROM positive)
      SELECT population, rides, circular, {pct("circular", "rides")} AS circular_pct,
        {pct("(rides - circular)", "rides")} AS one_way_pct FROM c""",
    # Routes
    "route_counts": f"""SELECT start_station_name, end_station_name, {N} AS rides,
        start_station_name = end_station_name AS is_circular
      FROM started GROUP BY start_station_name, end_station_name""",
    "top_routes_oneway": f"""SELECT start_station_name AS "from", end_station_name AS "to", {N} AS rides
      FROM started WHERE start_station_name <> end_station_name
      GROUP BY start_station_name, end_station_name ORDER BY rides DESC, "from", "to" LIMIT 50""",
    "top_routes_circular": f"""SELECT start_station_name AS station, {N} AS rides FROM started
      WHERE start_station_name = end_station_name GROUP BY start_station_name
      ORDER BY rides DESC, station LIMIT 30""",
    "asymmetric_routes": f"""r AS (SELECT start_station_name AS a, end_station_name AS b, {N} AS rides
        FROM started WHERE start_station_name <> end_station_name
        GROUP BY start_station_name, end_station_name HAVING count(*) > 80)
      SELECT x.a AS station_a, x.b AS station_b, x.rides AS a_to_b, y.rides AS b_to_a,
        {pct("x.rides", "(x.rides + y.rides)")} AS asymmetry_pct
      FROM r x JOIN r y ON x.a = y.b AND x.b = y.a
      ORDER BY asymmetry_pct DESC, station_a, station_b LIMIT 15""",
    "top_routes_labelled": f"""r AS (SELECT start_station_name, end_station_name, {N} AS rides FROM positive
        WHERE start_station_name IS NOT NULL AND end_station_name IS NOT NULL
        GROUP BY start_station_name, end_station_name
        ORDER BY rides DESC, start_station_name, end_station_name LIMIT 15)
      SELECT *, start_station_name = end_station_name AS is_circular,
        start_station_name || '  →  ' || end_station_name AS label FROM r""",
    "top_routes_geo": f"""r AS (SELECT start_station_name, end_station_name, start_lat, start_lng,
          end_lat, end_lng, {N} AS rides, start_station_name = end_station_name AS is_circular
        FROM positive WHERE start_station_name IS NOT NULL AND end_station_name IS NOT NULL
        GROUP BY start_station_name, end_station_name, start_lat, start_lng, end_lat, end_lng
        ORDER BY rides DESC, start_station_name, end_station_name, start_lat, start_lng, end_lat, end_lng
        LIMIT 20)
      SELECT *, CASE WHEN max(rides) OVER (PARTITION BY is_circular) > min(rides) OVER (PARTITION BY is_circular)
        THEN CASE WHEN is_circular THEN {scale(6, 26, "PARTITION BY is_circular")}
          ELSE {scale(1, 6, "PARTITION BY is_circular")} END END AS size
      FROM r""",
    # Seasons
    "season_volume": f"SELECT season, {N} AS rides FROM valid GROUP BY season",
    "season_duration": f"""SELECT season, {mean_min("sum(secs)", "count(*)")} AS avg_min,
        {as_min("quantile_cont(secs::DOUBLE, 0.5)")} AS median_min,
        {as_min("quantile_cont(secs::DOUBLE, 0.95)")} AS p95_min FROM valid GROUP BY season""",
    "season_bike_mix": f"""SELECT season, rideable_type, {N} AS rides FROM valid
      GROUP BY season, rideable_type""",
    "season_user_mix": f"""SELECT season, member_casual, {N} AS rides FROM valid
      GROUP BY season, member_casual""",
    "season_by_year": f"SELECT year, season, {N} AS rides FROM valid GROUP BY year, season",
    "season_by_year_nested": f"""y AS (SELECT year, season, {N} AS rides FROM valid GROUP BY year, season)
      SELECT year, {json_object("season", "rides")} AS seasons
      FROM y GROUP BY year""",
    "season_electric_share": f"""c AS (SELECT season, {where("rideable_type = 'classic_bike'")} AS classic,
        {where("rideable_type = 'electric_bike'")} AS electric FROM valid GROUP BY season)
      SELECT *, CASE WHEN classic + electric > 0 THEN {pct("electric", "(classic + electric)")}
        ELSE 0 END AS pct_electric FROM c""",
    "season_casual_share": f"""c AS (SELECT season, {where("member_casual = 'member'")} AS member,
        {where("member_casual = 'casual'")} AS casual FROM valid GROUP BY season)
      SELECT *, CASE WHEN member + casual > 0 THEN {pct("casual", "(member + casual)")} ELSE 0 END
          AS pct_casual,
        CASE WHEN member + casual > 0 THEN {pct("member", "(member + casual)")} ELSE 0 END AS pct_member
      FROM c""",
    # Circular trips
    "circular_overall": f"""c AS (SELECT {N} AS total_rides, {where("is_circular")} AS circular_rides FROM valid)
      SELECT *, {pct("circular_rides", "total_rides", 2)} AS pct_circular FROM c""",
    "circular_by_user": f"""c AS (SELECT member_casual, {N} AS total_rides,
        {where("is_circular")} AS circular_rides FROM valid GROUP BY member_casual)
      SELECT *, {pct("circular_rides", "total_rides", 2)} AS pct_circular FROM c""",
    "circular_duration": profile("label", "quantile_cont"),
    "circular_top_count": f"""SELECT start_station_name AS station, {N} AS circular_rides FROM valid
      WHERE is_circular GROUP BY start_station_name ORDER BY circular_rides DESC, station LIMIT 20""",
    "circular_top_rate": f"""c AS (SELECT start_station_name AS station, {N} AS total_rides,
        {where("is_circular")} AS circular_rides FROM valid GROUP BY start_station_name
        HAVING count(*) > 2000)
      SELECT *, {pct("circular_rides", "total_rides")} AS pct_circular FROM c
      ORDER BY pct_circular DESC, station NULLS LAST LIMIT 20""",
    "circular_station_share": f"""c AS (SELECT start_station_name AS station, {N} AS circular_rides
        FROM positive WHERE is_circular GROUP BY start_station_name
        ORDER BY circular_rides DESC, station LIMIT 10),
      t AS (SELECT start_station_name AS station, {N} AS total_rides FROM positive GROUP BY start_station_name)
      SELECT c.station, total_rides, circular_rides, {pct("circular_rides", "total_rides")} AS pct_circular
      FROM c JOIN t ON c.station = t.station""",
    "circular_split": f"""c AS (SELECT label, {N} AS rides FROM positive GROUP BY label)
      SELECT *, {pct("rides", "(SELECT count(*) FROM positive)")} AS pct FROM c""",
    "circular_user_share": f"""c AS (SELECT member_casual, {where("is_circular")} AS circular, {N} AS rides
        FROM positive WHERE member_casual IS NOT NULL GROUP BY member_casual),
      a AS (SELECT {total("circular")} AS all_circular, {total("rides")} AS all_rides FROM c)
      SELECT member_casual, {pct("circular", "all_circular")} AS circular_pct,
        {pct("rides", "all_rides")} AS overall_pct FROM c, a""",
    "circular_histogram": f"""b AS (SELECT label, CAST(least(us * 59 // 5400000000, 58) + 1 AS BIGINT) AS bin
      FROM positive WHERE label <> 'unknown' AND us BETWEEN 0 AND 5400000000)
      SELECT l.label, CAST(x AS BIGINT) AS bin, ((x - 1) * 5400000000)::DOUBLE / 3540000000 AS low,
        (x * 5400000000)::DOUBLE / 3540000000 AS high, CAST(count(b.bin) AS BIGINT) AS rides
      FROM (SELECT DISTINCT label FROM positive WHERE label <> 'unknown') l, generate_series(1, 59) AS axis(x)
      LEFT JOIN b ON b.label = l.label AND b.bin = x GROUP BY l.label, x""",
    "circular_box": box("label", 90, "label <> 'unknown'"),
    # Recommendation
    "station_hour_starts": f"""SELECT hour, start_station_name AS station, {N} AS starts FROM bounded_named
      GROUP BY hour, start_station_name""",
    "station_hour_ends": f"""SELECT end_hour AS hour, end_station_name AS station, {N} AS ends
      FROM bounded_named GROUP BY end_hour, end_station_name""",
    "station_net_inflow": f"{INFLOW} SELECT hour, station, starts, ends, score FROM inflow",
    "recommend_best": f"{INFLOW} SELECT hour, station, score, starts, ends FROM ranked WHERE rank = 1",
    "recommend_top5": f"{INFLOW} SELECT hour, rank, station, score, starts, ends FROM ranked WHERE rank <= 5",
    "recommend_at": f"""{INFLOW} SELECT hour, rank, station, score, starts, ends,
        CASE WHEN score > 0 THEN 'accumulate' ELSE 'scarce' END AS outlook
      FROM ranked WHERE hour = 8 AND rank <= 5""",
    "net_inflow_topk": f"""ev AS (
        SELECT hour, start_station_name AS station, 1 AS s, 0 AS e FROM positive WHERE hour IN (8, 17)
        UNION ALL SELECT end_hour, end_station_name, 0, 1 FROM positive WHERE end_hour IN (8, 17)),
      n AS (SELECT hour, station, {total("e - s")} AS net_inflow, {N} AS total_activity,
          {total("s")} AS starts, {total("e")} AS ends
        FROM ev WHERE station IS NOT NULL GROUP BY hour, station HAVING count(*) > 50),
      r AS (SELECT *, row_number() OVER (PARTITION BY hour ORDER BY net_inflow DESC, station) AS rn FROM n)
      SELECT hour, station, net_inflow, total_activity, starts, ends FROM r WHERE rn <= 10""",
    # Overview and quality
    "overview_counts": f"""SELECT {N} AS total_rides,
        CAST(count(DISTINCT start_station_name) AS BIGINT) AS start_stations,
        CAST(count(DISTINCT end_station_name) AS BIGINT) AS end_stations,
        min(started_at) AS first_start, max(started_at) AS last_start FROM positive""",
    "overview_mix": f"""c AS (
        SELECT 'user' AS dimension, member_casual AS value, {N} AS rides FROM positive GROUP BY member_casual
        UNION ALL SELECT 'bike', rideable_type, {N} FROM positive GROUP BY rideable_type)
      SELECT *, {pct("rides", "(SELECT count(*) FROM positive)")} AS pct FROM c""",
    "overview_duration": f"""SELECT
        CAST((20 * CAST(sum(us) AS HUGEINT) + 60000000 * CAST(count(*) AS HUGEINT))
          // (120000000 * CAST(count(*) AS HUGEINT)) AS DOUBLE) / 10 AS avg_min,
        {as_min("quantile_cont(us::DOUBLE, 0.5) / 1000000")} AS median_min FROM positive""",
    "load_profile": f"""SELECT {N} AS rows_loaded, {where("started_at IS NULL")} AS bad_start,
        {where("ended_at IS NULL")} AS bad_end, {where("secs <= 0 OR secs >= 86400")} AS bad_duration,
        {where("start_station_name IS NULL")} AS no_start_station,
        {where("end_station_name IS NULL")} AS no_end_station FROM trips""",
    "file_row_faults": f"""SELECT file_name, {N} AS rows, count(*) FILTER (WHERE CAST(ride_id AS BIGINT) % 61 = 0) AS short,
        count(*) FILTER (WHERE CAST(ride_id AS BIGINT) % 61 <> 0 AND CAST(ride_id AS BIGINT) % 67 = 0) AS long
      FROM trips GROUP BY file_name""",
    "file_selection": f"""SELECT file_name, file_name LIKE '%.csv' AND file_name NOT LIKE 'JC-%' AS wanted,
        nullif(regexp_extract(file_name, '^[0-9]{{6}}'), '') AS period, {N} AS rides
      FROM trips GROUP BY file_name""",
    "file_load_plan": f"""l AS (SELECT file_name, rideable_type || '/' || file_name AS path, {N} AS rides
        FROM trips WHERE file_name LIKE '%.csv' AND file_name NOT LIKE 'JC-%' GROUP BY file_name, rideable_type)
      SELECT file_name, path, rides,
        CASE WHEN file_name IN ('199901-trips.csv', '200006-trips_2.csv', 'trips.csv') THEN 'skipped'
          WHEN path = (SELECT min(path) FROM l m WHERE m.file_name = l.file_name) THEN 'new' ELSE 'repeated' END AS status
      FROM l""",
}


def _text(body: str) -> str:
    joint = "" if body.startswith("SELECT") else ","
    return f"{TRIPS}{joint}\n{body}"


SQL = {name: _text(body) for name, body in BODIES.items()}
