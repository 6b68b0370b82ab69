"""Dates and timestamps of the feeds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = dt.date(9999, 12, 31)


def as_date(as_of: Column | dt.date | str | None) -> Column:
    """The processing day: a column, a literal day, or today when none is given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def as_timestamp(at: Column | dt.datetime | str | None) -> Column:
    """The processing time: a column, a literal, or now when none is given."""
    if at is None:
        return F.current_timestamp()
    if isinstance(at, Column):
        return at
    return F.lit(str(at)).cast("timestamp")


def date_from_epoch_days(days: Column) -> Column:
    """Epoch days to a date, free of time zones and of 32-bit seconds."""
    return F.date_from_unix_date(days)


def timestamp_from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def date_key(day: Column) -> Column:
    """The day as a yyyymmdd integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
