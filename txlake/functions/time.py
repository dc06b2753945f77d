"""Event-time parsing and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.schemas import EVENT_TIME_FORMAT


def parse_event_time(text: Column, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """Wire event time -> timestamp: ``T`` becomes a space, then ``fmt``.

    ``try_to_timestamp`` gives null for text that does not fit (garbage,
    fractional seconds) instead of failing the batch under ANSI mode.
    """
    return F.try_to_timestamp(F.regexp_replace(text, "T", " "), F.lit(fmt))


def format_event_time(ts: Column, sep: str = " ") -> Column:
    """Timestamp -> wire text with second precision, ``T`` or space separated."""
    if sep == "T":
        return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.date_format(ts, f"yyyy-MM-dd{sep}HH:mm:ss")
