"""Dates and timestamps; the caller gives the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_timestamp(value: Column) -> Column:
    """Read a timestamp that may be epoch microseconds or a date-time text."""
    text = value.cast("string")
    return F.coalesce(
        F.timestamp_micros(text.try_cast("bigint")),
        text.try_cast("timestamp"),
    )


def since(day: Column, as_of: dt.date, days_back: int) -> Column:
    """``day`` lies at most ``days_back`` days before ``as_of``.

    The cutoff is a literal, so a date partition column is pruned at planning.
    """
    return day >= F.lit(as_of - dt.timedelta(days=days_back))


def retained_from(now: dt.datetime, days: int) -> dt.date:
    """First day whose midnight is not older than ``days`` before ``now``."""
    cutoff = now - dt.timedelta(days=days)
    midnight = cutoff.replace(hour=0, minute=0, second=0, microsecond=0)
    return midnight.date() if cutoff == midnight else midnight.date() + dt.timedelta(days=1)


def as_timestamp(now: dt.datetime | None) -> Column:
    """A literal timestamp in UTC, or the clock when none is given."""
    if now is None:
        return F.current_timestamp()
    return F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz").cast("timestamp")
