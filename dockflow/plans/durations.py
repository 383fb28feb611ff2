"""How long rides take."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.figures import (
    MICROS_PER_MINUTE,
    MICROS_PER_SECOND,
    exact_sum,
    mean_minutes,
    ratio,
    seconds_as_minutes,
)
from dockflow.functions.trip import CLASSIC, ELECTRIC, count_where, positive, rides, valid
from dockflow.operators.box import box_statistics
from dockflow.operators.histogram import range_histogram
from dockflow.operators.quantiles import (
    by_second,
    counted,
    per_type,
    ranked_profile,
    second_profile,
    wide_quantiles,
)

TYPICAL = {"median": 0.5, "p95": 0.95}
SPREAD = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
SKETCH_ACCURACY = 10000
#: Size of a period's sketch, and a bound of its rank error that it keeps with near certainty.
PERIOD_SKETCH, PERIOD_SLACK = 4096, 0.005


def _sketched(trips: DataFrame, keys: Sequence[str], quantiles: dict[str, float]) -> DataFrame:
    """As ``ranked_profile``, with Spark's quantile sketch: rank error up to 1/10000."""
    sketches = [
        F.percentile_approx("duration_secs", p, SKETCH_ACCURACY).alias(name)
        for name, p in quantiles.items()
    ]
    return trips.groupBy(*keys).agg(
        rides(), F.sum("duration_secs").alias("total_secs"), *sketches
    )


def _in_minutes(profile: DataFrame, keys: Sequence[str]) -> DataFrame:
    return profile.select(
        *keys,
        "rides",
        mean_minutes(F.col("total_secs"), F.col("rides")).alias("avg_min"),
        *[seconds_as_minutes(F.col(name)).alias(f"{name}_min") for name in TYPICAL],
    )


def duration_by_bike(trips: DataFrame, sketch: bool = False) -> DataFrame:
    """Mean, median and 95th percentile per bike type, quantiles as observed durations.

    ``sketch=True`` takes Spark's approximate percentile instead of the counted ranks.
    """
    profile = _sketched if sketch else ranked_profile
    return _in_minutes(profile(valid(trips), ["rideable_type"], TYPICAL), ["rideable_type"])


def duration_by_bike_user(trips: DataFrame, sketch: bool = False) -> DataFrame:
    keys = ["rideable_type", "member_casual"]
    profile = _sketched if sketch else ranked_profile
    return _in_minutes(profile(valid(trips), keys, TYPICAL), keys)


def duration_percentiles(trips: DataFrame, sketch: bool = False) -> DataFrame:
    """Seven points of the distribution in minutes; NULL if there are no rides."""
    profile = (_sketched if sketch else ranked_profile)(valid(trips), [], SPREAD)
    return profile.select(*[seconds_as_minutes(F.col(name)).alias(name) for name in SPREAD])


def _within(
    rows: DataFrame,
    keys: Sequence[str],
    quantiles: dict[str, float],
    sketched: DataFrame,
    slack: float = 1 / SKETCH_ACCURACY,
) -> DataFrame:
    """Rows (keys, quantile, rides, exact_min, within): whether the sketched value (an array of them,
    ``_sketch``) lies within the sketch's rank error of the wanted rank, next to the exact value of that rank."""
    seconds = _beside(counted(rows, keys, "duration_secs"), sketched, keys)
    value = {name: F.col("_sketch")[i] for i, name in enumerate(quantiles)}
    at = F.col("duration_secs")
    ranked = seconds.groupBy(*keys).agg(
        *[count_where(at < value[name], f"below_{name}") for name in quantiles],
        *[count_where(at <= value[name], f"upto_{name}") for name in quantiles],
    )
    off = F.ceil(F.col("rides") * slack)
    found = []
    for name, p in quantiles.items():
        rank = F.ceil(F.col("rides") * p)
        near = (F.col(f"below_{name}") < rank + off) & (F.col(f"upto_{name}") >= rank - off)
        exact = seconds_as_minutes(F.col(name)).alias("exact_min")
        found.append(F.struct(F.lit(name).alias("quantile"), exact, near.alias("within")))
    both = _beside(ranked_profile(rows, keys, quantiles), ranked, keys)
    return both.select(*keys, "rides", F.inline(F.array(*found)))


def _beside(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    own = right.withColumnsRenamed({key: f"_r_{key}" for key in keys})
    return left.join(per_type(own, keys), [F.col(key).eqNullSafe(F.col(f"_r_{key}")) for key in keys])


def duration_sketch_by_bike(trips: DataFrame) -> DataFrame:
    """Spark's approximate percentile per bike type, held against the exact ranks."""
    each = [F.percentile_approx("duration_secs", p, SKETCH_ACCURACY) for p in TYPICAL.values()]
    rows, keys = valid(trips), ["rideable_type"]
    return _within(rows, keys, TYPICAL, rows.groupBy(*keys).agg(F.array(*each).alias("_sketch")))


def duration_sketch_by_bike_user(trips: DataFrame) -> DataFrame:
    """The same for seven points at once, per bike and user type."""
    points = F.percentile_approx("duration_secs", list(SPREAD.values()), SKETCH_ACCURACY)
    rows, keys = valid(trips), ["rideable_type", "member_casual"]
    return _within(rows, keys, SPREAD, rows.groupBy(*keys).agg(points.alias("_sketch")))


def period_sketches(trips: DataFrame) -> DataFrame:
    """A mergeable sketch of the durations per file period, bike and user type. A task sends one for
    each of the few periods that it has rows of, and no reducer gets those of all periods."""
    grain = ("file_period", "rideable_type", "member_casual")
    return valid(trips).groupBy(*grain).agg(
        F.kll_sketch_agg_bigint("duration_secs", PERIOD_SKETCH).alias("sketch"), rides("n"), F.sum("total_secs").alias("total_secs")
    )


def merged_sketches(sketches: DataFrame, keys: Sequence[str] = ("file_period", "rideable_type", "member_casual")) -> DataFrame:
    """Sketches rolled up to ``keys``; the rides themselves are not looked at."""
    return sketches.groupBy(*keys).agg(
        F.kll_merge_agg_bigint("sketch", PERIOD_SKETCH).alias("sketch"), F.sum("n").alias("n"), F.sum("total_secs").alias("total_secs")
    )


def _in_periods(frame: DataFrame, first: str | None, last: str | None) -> DataFrame:
    if first is not None:
        frame = frame.filter(F.col("file_period") >= first)
    return frame if last is None else frame.filter(F.col("file_period") <= last)


def duration_rollup(
    sketches: DataFrame, keys: Sequence[str] = ("rideable_type",), first: str | None = None, last: str | None = None
) -> DataFrame:
    """rides, avg_min and the usual quantiles of any run of file periods, from their sketches alone."""
    merged = merged_sketches(_in_periods(sketches, first, last), keys)
    value = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)).alias(name) for name, p in TYPICAL.items()]
    return _in_minutes(merged.select(*keys, F.col("n").alias("rides"), "total_secs", *value), keys)


def duration_sketch_rollup(trips: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Quantiles per bike type of a run of file periods, from sketches per period, held against the
    exact ranks."""
    keys = ["rideable_type"]
    merged = merged_sketches(period_sketches(_in_periods(trips, first, last)), keys)
    points = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)) for p in SPREAD.values()]
    sketched = merged.select(*keys, F.array(*points).alias("_sketch"))
    return _within(valid(_in_periods(trips, first, last)), keys, SPREAD, sketched, PERIOD_SLACK)


def duration_by_bike_exact(trips: DataFrame) -> DataFrame:
    """As ``duration_by_bike``, with exact interpolated quantiles."""
    profile = second_profile(valid(trips), ["rideable_type"], TYPICAL)
    return _in_minutes(profile, ["rideable_type"])


def mean_of(unit: int) -> Column:
    """The mean value, over the table of seconds."""
    base = F.col("_second") * MICROS_PER_SECOND
    return ratio(exact_sum(base, F.col("n")) + exact_sum(F.col("_over")), F.sum("n"), unit)


def describe(frame: DataFrame, unit: int) -> DataFrame:
    """count, mean, sample deviation, minimum, quartiles and maximum of ``duration_us``.

    All but the quartiles come from one row per whole second: its rides, and the sums of what
    they go beyond it, plain and squared; the quartiles from that table and one more read. The deviation is added up around the mean, which loses
    no digits to cancellation.
    """
    seconds = by_second(frame, [], "duration_us")
    n, over = F.col("n"), F.col("_over")
    base = F.col("_second") * MICROS_PER_SECOND
    mean = mean_of(unit)
    center = seconds.agg(mean.alias("mean")).scalar()
    quartiles = wide_quantiles(frame, [], "duration_us", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, seconds)
    points = quartiles.select(F.struct("p25", "p50", "p75")).scalar()
    off = base / unit - F.col("center")
    squares = F.sum(n * off * off + 2 * off * over / unit + F.col("_squares") / unit / unit)
    summary = (
        seconds.withColumn("center", center)
        .agg(
            F.coalesce(F.sum(n), F.lit(0)).alias("count"),
            mean.alias("mean"),
            F.sqrt(F.try_divide(squares, F.sum(n) - 1)).alias("std"),
            (F.min("_low") / unit).alias("min"),
            (F.max("_high") / unit).alias("max"),
        )
        .withColumn("points", points)
    )

    def shown(column: Column, name: str) -> Column:
        return F.round(column, 6).alias(name)

    return summary.select(
        "count",
        shown(F.col("mean"), "mean"),
        shown(F.col("std"), "std"),
        shown(F.col("min"), "min"),
        *[shown(F.col(f"points.{p}") / unit, p) for p in ("p25", "p50", "p75")],
        shown(F.col("max"), "max"),
    )


def duration_describe(trips: DataFrame) -> DataFrame:
    return describe(positive(trips), MICROS_PER_MINUTE)


def _capped(minutes: int) -> Column:
    return F.least(F.col("duration_us"), F.lit(minutes * MICROS_PER_MINUTE))


def duration_histogram(trips: DataFrame, bins: int = 80, cap: int = 120) -> DataFrame:
    """Equal bins over the observed range, longer rides counted at the cap."""
    return range_histogram(positive(trips), _capped(cap), bins, MICROS_PER_MINUTE)


def duration_box_by_bike(trips: DataFrame, cap: int = 120) -> DataFrame:
    two_types = positive(trips).filter(F.col("rideable_type").isin(CLASSIC, ELECTRIC))
    return box_statistics(two_types, "rideable_type", _capped(cap), MICROS_PER_MINUTE)
