"""Messages out of the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.calendar import first_timestamp
from waymark.functions.events import MESSAGE


def normalize_messages(events: DataFrame, lenient: bool = True) -> DataFrame:
    """Flat messages: ``message_id, user_id, datetime, lat, lon, date``.

    The time is the first readable one of ``message_ts`` and ``datetime``, else the day.
    ``lenient=False`` takes only strings with a fraction of a second.
    """
    return events.where(F.col("event_type") == MESSAGE).select(
        F.col("event.message_id").alias("message_id"),
        F.col("event.message_from").alias("user_id"),
        first_timestamp(
            [F.col("event.message_ts"), F.col("event.datetime")], F.col("date"), lenient
        ).alias("datetime"),
        "lat",
        "lon",
        "date",
    )
