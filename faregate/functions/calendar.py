"""Date parts and durations on timestamps without a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(ts: Column) -> Column:
    """``yyyy-MM-dd`` text; through DATE, so the session zone plays no part."""
    return ts.cast("date").cast("string")


def monday_based_weekday(ts: Column) -> Column:
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts).isin(5, 6)


def duration_seconds(start: Column, end: Column) -> Column:
    """Fractional seconds from start to end; negative when end comes first."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1_000_000.0)


def plus_seconds(ts: Column, seconds: Column) -> Column:
    nothing = F.lit(0)
    return ts + F.make_dt_interval(nothing, nothing, nothing, seconds)


def parsed_date(text: Column) -> Column:
    """The date in ``yyyy-MM-dd`` text, null where the text is no such date."""
    return F.try_to_date(text, "yyyy-MM-dd")
