"""Wall-clock time.

Trip times carry no zone, so they are TIMESTAMP_NTZ throughout: no result depends on
``spark.sql.session.timeZone`` and no ride gains or loses an hour at a clock change.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names, Monday first.
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def parse_wall_clock(text: Column) -> Column:
    """Text to timestamp; text that is not a timestamp becomes NULL, also in ANSI mode."""
    return text.try_cast("timestamp_ntz")


def seconds_since(origin: str, ts: Column) -> Column:
    """Whole seconds from a date on the same clock; fractions are cut."""
    return (ts - F.lit(origin).cast("timestamp_ntz")).cast("interval second").cast("bigint")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Difference of the two whole-second readings: 2.1 s minus 1.9 s is 1.

    Each timestamp is mentioned once: a filter on the result is evaluated before the columns
    are, and would otherwise parse the text once for every mention.
    """
    return seconds_since("0001-01-01", end) - seconds_since("0001-01-01", start)


def elapsed_micros(start: Column, end: Column) -> Column:
    """Elapsed time with its fraction, as an exact count of microseconds."""
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1000000).cast("bigint")


def iso_weekday(ts: Column) -> Column:
    """1 = Monday … 7 = Sunday."""
    return F.weekday(ts) + 1


def day_name(dow: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in DAY_NAMES]), dow.cast("int"))


def month_label(month_no: Column) -> Column:
    """``202306`` as ``2023-06``. For results: months are grouped by their number."""
    return F.format_string("%04d-%02d", F.floor(month_no / 100), month_no % 100)


def month_name(month: Column) -> Column:
    return F.monthname(F.make_date(F.lit(2000), month.cast("int"), F.lit(1)))


def day_class(dow: Column) -> Column:
    return F.when(dow >= 6, "weekend").otherwise("weekday")


def season(month: Column) -> Column:
    """December belongs to the winter of its own calendar year."""
    return (
        F.when(month.between(3, 5), "spring")
        .when(month.between(6, 8), "summer")
        .when(month.between(9, 11), "fall")
        .otherwise("winter")
    )
