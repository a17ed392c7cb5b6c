"""Event time from the ways a feed may write it, and emission stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def event_time(column: Column, unit: str = "ms") -> Column:
    """Instant of a tick; null where the text cannot be read.

    ``ms``: epoch milliseconds, text or number. ``s``: epoch seconds, cut to
    whole milliseconds. ``datetime``: ``2024-01-31 09:30:00`` in UTC.
    """
    if unit == "ms":
        return F.timestamp_millis(column.try_cast("bigint"))
    if unit == "s":
        return F.timestamp_millis((column.try_cast("double") * 1000).try_cast("bigint"))
    if unit == "datetime":
        return F.try_to_timestamp(column, F.lit(DATETIME_FORMAT))
    raise ValueError(f"unknown unit of time: {unit}")


def emission_stamp(stamp: str, event: Column) -> Column:
    """When a result was made: wall clock, or the event time of its tick."""
    if stamp == "processing":
        return F.current_timestamp()
    if stamp == "event":
        return event
    raise ValueError(f"unknown stamp: {stamp}")
