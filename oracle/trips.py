"""The trip view and its populations as common table expressions."""

RAW = """
WITH line AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_linestatus, l.l_returnflag, o.o_orderdate,
    CAST(l.l_quantity AS BIGINT) AS q,
    CAST(sn.n_nationkey AS BIGINT) AS s_id, sn.n_name AS s_name,
    CAST(cn.n_nationkey AS BIGINT) AS e_id, cn.n_name AS e_name,
    CAST(epoch(o.o_orderdate) AS BIGINT)
      + (l.l_orderkey * 7919 + l.l_linenumber * 104729 + l.l_partkey * 31) % 86400 AS start_s
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
), timed AS (
  SELECT *,
    CASE WHEN l_partkey % 89 = 0 THEN 0
         WHEN l_partkey % 83 = 0 THEN -q
         WHEN l_partkey % 79 = 0 THEN 86400 + q
         ELSE q * 47 + l_orderkey % 600 + CASE WHEN s_id = e_id THEN 600 ELSE 0 END END AS dur
  FROM line
), raw AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS ride_id,
    CASE WHEN l_linestatus = 'O' THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
    CASE WHEN l_partkey % 97 = 0 THEN 'n/a'
      ELSE strftime(make_timestamp(start_s * 1000000), '%Y-%m-%d %H:%M:%S') END AS started_text,
    CASE WHEN l_partkey % 101 = 0 THEN 'n/a'
      ELSE strftime(make_timestamp((start_s + dur) * 1000000), '%Y-%m-%d %H:%M:%S') END
      AS ended_text,
    CASE WHEN l_partkey % 103 = 0 THEN NULL ELSE s_name END AS start_station_name,
    CASE WHEN l_partkey % 107 = 0 THEN NULL ELSE e_name END AS end_station_name,
    CAST(40.0 + s_id * 0.01 AS DOUBLE) AS start_lat, CAST(-74.0 + s_id * 0.01 AS DOUBLE) AS start_lng,
    CAST(40.0 + e_id * 0.01 AS DOUBLE) AS end_lat, CAST(-74.0 + e_id * 0.01 AS DOUBLE) AS end_lng,
    CASE WHEN l_returnflag = 'R' THEN 'casual' ELSE 'member' END AS member_casual,
    CASE l_linenumber % 7 WHEN 0 THEN 'JC-' || strftime(o_orderdate, '%Y%m') || '-trips.csv'
      WHEN 1 THEN strftime(o_orderdate, '%Y%m') || '-trips.txt' WHEN 2 THEN 'trips.csv'
      WHEN 3 THEN strftime(o_orderdate, '%Y%m') || '-trips_2.csv'
      ELSE strftime(o_orderdate, '%Y%m') || '-trips.csv' END AS file_name,
    strftime(o_orderdate, '%Y%m') AS file_period
  FROM timed
)"""

POPULATIONS = """, parsed AS (
  SELECT *, TRY_CAST(started_text AS TIMESTAMP) AS started_at, TRY_CAST(ended_text AS TIMESTAMP) AS ended_at
  FROM raw
), trips AS (
  SELECT *,
    CAST(floor(epoch(ended_at)) AS BIGINT) - CAST(floor(epoch(started_at)) AS BIGINT) AS secs,
    epoch_us(ended_at) - epoch_us(started_at) AS us,
    CAST(year(started_at) AS BIGINT) AS year, CAST(month(started_at) AS BIGINT) AS month,
    strftime(started_at, '%Y-%m') AS ym,
    CAST(hour(started_at) AS BIGINT) AS hour, CAST(hour(ended_at) AS BIGINT) AS end_hour,
    CAST(isodow(started_at) AS BIGINT) AS dow,
    CASE WHEN isodow(started_at) IN (6, 7) THEN 'weekend' ELSE 'weekday' END AS is_weekend,
    CASE WHEN month(started_at) IN (12, 1, 2) THEN 'winter'
         WHEN month(started_at) IN (3, 4, 5) THEN 'spring'
         WHEN month(started_at) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season,
    start_station_name = end_station_name AS is_circular,
    CASE WHEN start_station_name = end_station_name THEN 'circular'
         WHEN start_station_name <> end_station_name THEN 'one_way' ELSE 'unknown' END AS label
  FROM parsed
), started AS (SELECT * FROM trips WHERE started_at IS NOT NULL
), bounded AS (SELECT * FROM started WHERE ended_at IS NOT NULL
), bounded_named AS (
  SELECT * FROM bounded WHERE start_station_name IS NOT NULL AND end_station_name IS NOT NULL
), valid AS (SELECT * FROM bounded WHERE secs > 0 AND secs < 86400
), positive AS (SELECT * FROM bounded WHERE us > 0
)"""

TRIPS = RAW + POPULATIONS


def pct(part: str, whole: str, digits: int = 1) -> str:
    """100 * part / whole, half-up, in integer arithmetic; for part >= 0."""
    scale = 10**digits
    part, whole = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return f"CAST(({200 * scale} * {part} + {whole}) // (2 * {whole}) AS DOUBLE) / {scale}"


def signed_pct(part: str, whole: str, digits: int = 1) -> str:
    """As ``pct``, rounding half away from zero."""
    return f"CASE WHEN {part} < 0 THEN -1 ELSE 1 END * {pct(f'abs({part})', whole, digits)}"


def mean_min(total: str, rides: str) -> str:
    """Mean minutes to one decimal from a sum of seconds."""
    total, rides = f"CAST({total} AS HUGEINT)", f"CAST({rides} AS HUGEINT)"
    return f"CAST((20 * {total} + 60 * {rides}) // (120 * {rides}) AS DOUBLE) / 10"


def as_min(seconds: str) -> str:
    """Seconds as minutes to one decimal, half-up."""
    return f"floor({seconds} / 6.0::DOUBLE + 0.5) / 10"
