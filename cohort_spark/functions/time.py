"""Time expressions: elapsed clock, hour grid, normalised time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def as_ntz(value) -> Column:
    """A timestamp without zone from a string or a column."""
    return (F.lit(value) if isinstance(value, str) else value).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds as a double, exact to the microsecond."""
    return F.timestamp_diff("MICROSECOND", start, end).cast("double") / F.lit(1e6)


def elapsed_to_timestamp(hhmm: Column, base: str | Column) -> Column:
    """``HH:MM`` since ``base``; hours may run past 23 and then roll into later days."""
    parts = F.split(hhmm, ":")
    span = F.make_dt_interval(
        F.lit(0), F.try_element_at(parts, F.lit(1)).cast("int"), F.try_element_at(parts, F.lit(2)).cast("int")
    )
    return (as_ntz(base) + span).cast("timestamp_ntz")


def ceil_to_hour(ts: Column) -> Column:
    """The hour itself when ``ts`` is on the hour, the next one otherwise."""
    hour = F.date_trunc("hour", ts).cast("timestamp_ntz")
    return F.when(ts.cast("timestamp_ntz") > hour, hour + F.expr("interval 1 hour")).otherwise(hour)


def normalize_time(ts: Column, base: str | Column, duration_hours: float = 48) -> Column:
    """Position of ``ts`` in the window that starts at ``base``: 0 at its start, 1 at its end."""
    return seconds_between(as_ntz(base), ts) / F.lit(float(duration_hours) * 3600.0)
