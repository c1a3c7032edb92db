"""Event counts and registrations per city and period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.calendar import month_start, week_start
from waymark.functions.events import EVENT_TYPES, event_actor

CITY_WEEK = ("city", "week", "month")


def actor_events(events: DataFrame) -> DataFrame:
    """The log as ``message_id, user_id, event_type, date, week, month``, the user being the
    event's actor."""
    return events.select(
        F.col("event.message_id").alias("message_id"),
        event_actor().alias("user_id"),
        "event_type",
        "date",
        week_start(F.col("date")).alias("week"),
        month_start(F.col("date")).alias("month"),
    )


def user_cities(user_geo: DataFrame) -> DataFrame:
    return user_geo.select("user_id", F.col("act_city").alias("city"))


def events_with_city(events: DataFrame, user_geo: DataFrame) -> DataFrame:
    """Every event with its actor's current city; events of unknown actors are left out.

    One row per user on the one side, so a user with a large part of the log makes one side
    of the join skewed and adaptive execution splits that partition.
    """
    return actor_events(events).join(user_cities(user_geo), "user_id")


def activity_pivot(
    events: DataFrame,
    keys: Sequence[str],
    types: Sequence[str] = EVENT_TYPES,
    prefix: str = "",
    fill_zero: bool = False,
) -> DataFrame:
    """Event counts per ``keys``, a column ``<prefix><type>`` for each of the given types.

    Other types are ignored. A type that does not occur is NULL, or 0 with ``fill_zero``.
    The columns are conditional counts of one hash aggregate, combined map-side.
    """
    counts = {kind: F.count(F.when(F.col("event_type") == kind, 1)) for kind in types}
    return (
        events.where(F.col("event_type").isin(*types))
        .groupBy(*keys)
        .agg(
            *[
                (n if fill_zero else F.nullif(n, F.lit(0))).alias(prefix + kind)
                for kind, n in counts.items()
            ]
        )
    )


def roll_up(counts: DataFrame, keys: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Sum counts to coarser ``keys``; ``columns`` maps each count to its new name."""
    return counts.groupBy(*keys).agg(*[F.sum(c).alias(name) for c, name in columns.items()])


def city_activity(
    events: DataFrame,
    user_geo: DataFrame,
    keys: Sequence[str] = CITY_WEEK,
    prefix: str = "week_",
    fill_zero: bool = False,
) -> DataFrame:
    """Event counts per city and period, equal to pivoting ``events_with_city``.

    Events are counted per user and period before they meet the users: the log itself is
    never shuffled, and a user with a large part of it joins as one row per period.
    """
    periods = [k for k in keys if k != "city"]
    per_user = activity_pivot(actor_events(events), ["user_id", *periods], prefix=prefix)
    names = [prefix + kind for kind in EVENT_TYPES]
    placed = per_user.join(user_cities(user_geo), "user_id")
    rolled = roll_up(placed, keys, {n: n for n in names})
    return rolled.fillna(0, names) if fill_zero else rolled


def first_seen(message_city: DataFrame, user_geo: DataFrame) -> DataFrame:
    """``city, user_id, reg_date``: first message of each user in their current city.

    Messages shrink to one row per user and city before the join.
    """
    firsts = message_city.groupBy("user_id", "city").agg(F.min("date").alias("reg_date"))
    return firsts.join(user_cities(user_geo), ["user_id", "city"], "left_semi")


def registrations(message_city: DataFrame, user_geo: DataFrame) -> DataFrame:
    """``city, week, month, users``: users first seen in their current city in that week.

    ``first_seen`` has one row per user and city, so counting rows counts distinct users.
    """
    return (
        first_seen(message_city, user_geo)
        .groupBy(
            "city",
            week_start(F.col("reg_date")).alias("week"),
            month_start(F.col("reg_date")).alias("month"),
        )
        .agg(F.count(F.lit(1)).alias("users"))
    )
