"""Expressions over one row of the event log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The event types of the log.
MESSAGE = "message"
REACTION = "reaction"
SUBSCRIPTION = "subscription"
EVENT_TYPES = (MESSAGE, REACTION, SUBSCRIPTION)


def event_actor() -> Column:
    """User who caused the event: the subscriber, the one reacting, else the sender."""
    kind = F.col("event_type")
    return (
        F.when(kind == SUBSCRIPTION, F.col("event.user"))
        .when(kind == REACTION, F.col("event.reaction_from"))
        .otherwise(F.col("event.message_from"))
    )
