"""Time helpers that never consult the session time zone.

Event times are UTC wall-clock values held as ``timestamp_ntz``. Spark's
``date_trunc``, ``unix_timestamp`` and ``timestampdiff`` go through the session
zone for such values, so results would shift with a user's settings; the forms
below use only zone-free operations and stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400

_DATE_GRAINS = ("week", "month", "quarter", "year")


def epoch_to_ntz(seconds: Column) -> Column:
    """Unix seconds as a UTC ``timestamp_ntz``; a value that is no integer raises (ANSI)."""
    one_second = F.expr("interval '1' second")
    return F.expr("timestamp_ntz '1970-01-01 00:00:00'") + seconds.cast("bigint") * one_second


def minutes_between(start: Column, end: Column) -> Column:
    """Count of minute boundaries crossed: 00:00:59 to 00:02:01 is 2."""
    days = F.datediff(end.cast("date"), start.cast("date")).cast("bigint")
    return days * 1440 + _minute_of_day(end) - _minute_of_day(start)


def _minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def start_of(grain: str, ts: Column) -> Column:
    """Start of the day, week (Monday), month, quarter or year, or hour holding ``ts``."""
    day = ts.cast("date")
    if grain == "day":
        return day.cast("timestamp_ntz")
    if grain in _DATE_GRAINS:
        return F.trunc(day, grain).cast("timestamp_ntz")
    if grain == "hour":
        return day.cast("timestamp_ntz") + F.hour(ts) * F.expr("interval '1' hour")
    raise ValueError(f"unknown time grain: {grain!r}")


def hour_of(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")
