"""The event log: ingest into date/type directories, and date-window reads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.schemas import GEO_EVENTS
from waymark.sources.tables import read_table, write_table

EVENT_PARTITIONS = ("date", "event_type")


def ingest_events(raw: DataFrame, out_path: str, rebalance: bool = True) -> None:
    """Lay the raw log out by date and event type, the layout every later scan prunes on.

    All columns are kept. Pass ``rebalance=False`` when the source is already stored by
    date: its splits then hold few directories each and the copy needs no shuffle.
    """
    write_table(raw, out_path, EVENT_PARTITIONS, rebalance)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, GEO_EVENTS, "geo_events")


def events_window(events: DataFrame, end: dt.date | str, depth: int) -> DataFrame:
    """The ``depth`` days of the log that end at ``end``, both ends included.

    On the ingested layout the bounds reach the scan as partition filters.
    """
    first, last = window_days(end, depth)
    return events.where(F.col("date").between(F.lit(first), F.lit(last)))


def window_days(end: dt.date | str, depth: int) -> tuple[dt.date, dt.date]:
    """First and last of the ``depth`` days that end at ``end``."""
    if depth < 1:
        raise ValueError("depth must be at least one day")
    last = dt.date.fromisoformat(end) if isinstance(end, str) else end
    return last - dt.timedelta(days=depth - 1), last
