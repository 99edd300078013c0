"""Clock arithmetic on UTC timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value: dt.datetime | Column) -> Column:
    """A Column for a UTC instant; naive datetimes are read as UTC."""
    if isinstance(value, Column):
        return value
    aware = value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit(micros(aware)))


def micros(value: dt.datetime) -> int:
    """Microseconds since the epoch, in integer arithmetic."""
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    aware = value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
    return (aware - epoch) // dt.timedelta(microseconds=1)


def from_micros(value: int) -> dt.datetime:
    """Inverse of :func:`micros`, as an aware UTC datetime."""
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=value)


def whole_days(earlier: Column, later: Column) -> Column:
    """Complete 24-hour units between two instants, truncated toward zero.

    ``datediff`` would count calendar boundaries instead.
    """
    return F.timestamp_diff("DAY", earlier, later)


def floor_second(ts: Column) -> Column:
    return F.date_trunc("second", ts)
