"""Ridership by month and year over year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.clock import month_label, month_name
from dockflow.functions.figures import change_percent
from dockflow.functions.trip import CASUAL, MEMBER, count_where, rides, started
from dockflow.operators.axis import on_axis
from dockflow.operators.nested import keyed


def monthly_rides(trips: DataFrame) -> DataFrame:
    keys = [F.col(name).cast("bigint").alias(name) for name in ("year", "month")]
    return started(trips).groupBy(*keys).agg(rides())


def monthly_rides_by_user(trips: DataFrame) -> DataFrame:
    counts = started(trips).groupBy("month_no", "member_casual").agg(rides())
    label = month_label(F.col("month_no")).alias("ym")
    return counts.select(label, "member_casual", "rides")


def monthly_rides_by_user_nested(trips: DataFrame) -> DataFrame:
    """Rides of every user type of a month as one JSON object."""
    users = keyed(F.col("member_casual"), F.col("rides"))
    months = monthly_rides_by_user(trips).groupBy("ym").agg(users.alias("rides"))
    return months.withColumn("rides", F.to_json("rides"))


def _two_years(base: int, compare: int) -> list[Column]:
    year = F.col("year")
    return [count_where(year == base, "rides_base"), count_where(year == compare, "rides_cmp")]


def yoy_monthly(trips: DataFrame, base: int = 2023, compare: int = 2024) -> DataFrame:
    """All twelve months; no change is given for a month without rides in the base year."""
    month = F.col("month").cast("bigint").alias("month")
    years = started(trips).filter(F.col("year").isin(base, compare))
    counts = years.groupBy(month).agg(*_two_years(base, compare))
    return on_axis(counts, "month", 1, 12).select(
        "month",
        month_name(F.col("month")).alias("month_name"),
        "rides_base",
        "rides_cmp",
        change_percent(F.col("rides_base"), F.col("rides_cmp")).alias("change_pct"),
    )


def yoy_totals(trips: DataFrame, base: int = 2023, compare: int = 2024) -> DataFrame:
    years = started(trips).filter(F.col("year").isin(base, compare))
    totals = years.agg(*_two_years(base, compare))
    return totals.withColumn(
        "growth_pct", change_percent(F.col("rides_base"), F.col("rides_cmp"))
    )


def yoy_same_month(
    trips: DataFrame, base_period: str = "202306", compare_period: str = "202406"
) -> DataFrame:
    """Every row of the files of two months: all rides, members, casual riders, and the rest."""
    chosen = trips.filter(F.col("file_period").isin(base_period, compare_period))
    groups = {
        "total": F.lit(True),
        "member": F.col("member_casual") == MEMBER,
        "casual": F.col("member_casual") == CASUAL,
        "other": ~F.coalesce(F.col("member_casual").isin(MEMBER, CASUAL), F.lit(False)),
    }
    totals = chosen.agg(
        *[
            F.struct(
                F.lit(name).alias("category"),
                count_where((F.col("file_period") == base_period) & group, "rides_base"),
                count_where((F.col("file_period") == compare_period) & group, "rides_cmp"),
            ).alias(name)
            for name, group in groups.items()
        ]
    )
    rows = totals.select(F.inline(F.array(*groups)))
    growth = change_percent(F.col("rides_base"), F.col("rides_cmp"))
    return rows.withColumn("growth_pct", F.when(F.col("category") == "total", growth))


def monthly_volume_by_file(trips: DataFrame, year: int = 2024) -> DataFrame:
    """Rows per month of the file they came in, whatever their start says."""
    chosen = trips.filter(F.col("file_period").startswith(str(year)))
    month = F.substring("file_period", 5, 2).cast("bigint")
    counts = chosen.groupBy(month.alias("month")).agg(rides())
    return counts.select("month", month_name(F.col("month")).alias("month_name"), "rides")
