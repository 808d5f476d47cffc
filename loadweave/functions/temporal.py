"""Wall-clock helpers on TIMESTAMP_NTZ columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _floor(unit: str, ts: Column | str) -> Column:
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def hour_floor(ts: Column | str) -> Column:
    return _floor("hour", ts)


def day_floor(ts: Column | str) -> Column:
    return _floor("day", ts)


def month_floor(ts: Column | str) -> Column:
    return _floor("month", ts)


def minute_of_day(ts: Column | str) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole elapsed seconds."""
    return F.timestamp_diff("SECOND", start, end)
