"""Calendar buckets, timestamp parsing and local time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of the timestamp strings in the event log.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSSSSS"
TIMESTAMP_FORMAT_NO_FRACTION = "yyyy-MM-dd HH:mm:ss"


def week_start(date: Column) -> Column:
    """The Sunday on or before ``date``."""
    return F.date_sub(date, F.dayofweek(date) - 1)


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def parse_timestamp(text: Column, lenient: bool = True) -> Column:
    """Timestamp of a log string, NULL when it cannot be read.

    The log format wants a fraction of 1 to 9 digits (those past microseconds are cut).
    ``lenient`` also takes strings with no fraction; without it they become NULL.
    """
    parsed = F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT))
    if not lenient:
        return parsed
    return F.coalesce(parsed, F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT_NO_FRACTION)))


def first_timestamp(texts: list[Column], date: Column, lenient: bool = True) -> Column:
    """First readable string, else midnight of ``date``."""
    parsed = [parse_timestamp(text, lenient) for text in texts]
    return F.coalesce(*parsed, date.cast("timestamp"))


def utc_literal(at: dt.datetime) -> Column:
    """A moment as a timestamp, taken as UTC unless it names an offset, on a host of any zone."""
    return F.lit(at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)).cast("timestamp")


def local_time(utc: Column, zone: Column) -> Column:
    """Wall-clock time in ``zone``, daylight saving included; wants a UTC session."""
    return F.from_utc_timestamp(utc, zone)
