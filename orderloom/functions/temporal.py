"""Tolerant time parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(c: Column) -> Column:
    """ISO text to a UTC instant; anything unreadable becomes NULL."""
    return c.try_cast("timestamp")


def parse_time_or_epoch(c: Column) -> Column:
    """As :func:`parse_time`, also reading text digits as epoch milliseconds."""
    return F.coalesce(parse_time(c), F.timestamp_millis(c.try_cast("bigint")))


def event_time_with_fallback(c: Column, broker_time: Column, now: bool = True) -> Column:
    """The message's own time, else the broker's, else the current time."""
    options = [parse_time_or_epoch(c), broker_time]
    if now:
        options.append(F.current_timestamp())
    return F.coalesce(*options)


def time_parts(c: Column) -> dict[str, Column]:
    return {
        "event_year": F.year(c).cast("int"),
        "event_month": F.month(c).cast("int"),
        "event_day": F.dayofmonth(c).cast("int"),
        "event_hour": F.hour(c).cast("int"),
    }
