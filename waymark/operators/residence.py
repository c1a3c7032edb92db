"""Where users live, where they are now, and where they have been.

Each operator is a set of per-user aggregates over the streaks; the user mart computes all
of them in one grouping. Ties go to the later last action, then to the later city name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: days in a row that make a city a home.
HOME_DAYS = 27


def with_home_inputs(streaks: DataFrame) -> DataFrame:
    """Add each city's day total per user."""
    in_city = Window.partitionBy("user_id", "city")
    return streaks.withColumn("_city_days", F.sum("days").over(in_city))


def with_travel_inputs(streaks: DataFrame) -> DataFrame:
    """Mark the streaks that begin in another city than the one before ended in."""
    in_order = Window.partitionBy("user_id").orderBy("last_date", "last_action", "city")
    before = F.lag("city").over(in_order)
    return streaks.withColumn("_moved", before.isNull() | (before != F.col("city")))


def home_columns(min_days: int) -> list[Column]:
    """City of the latest long streak, else the city with most days.

    A user of a single city has it as top city, so that rule needs no term of its own.
    """
    long_stay = F.when(
        F.col("days") >= min_days, F.struct("last_date", "last_action", "city")
    )
    most_days = F.max(F.struct("_city_days", "last_action", "city"))
    return [F.coalesce(F.max(long_stay)["city"], most_days["city"]).alias("home_city")]


def current_columns(activity: str) -> list[Column]:
    if activity not in ("latest", "earliest"):
        raise ValueError(f"activity must be 'latest' or 'earliest', not {activity!r}")
    last_stay = F.max(F.struct("last_date", "last_action", "city"))
    pick = F.max if activity == "latest" else F.min
    return [
        last_stay["city"].alias("act_city"),
        pick("last_action").alias("last_action_time"),
    ]


def travel_columns() -> list[Column]:
    move = F.when(F.col("_moved"), F.struct("last_date", "last_action", "city"))
    # One entry per streak at most, so the list is bounded by the days a user was seen.
    moves = F.sort_array(F.collect_list(move))
    return [
        F.count(move).alias("travel_count"),
        moves["city"].alias("travel_array"),
    ]


def home_city(streaks: DataFrame, min_days: int = HOME_DAYS) -> DataFrame:
    """``user_id, home_city``: the city of the latest streak of ``min_days`` or more, else
    the city with most days."""
    return with_home_inputs(streaks).groupBy("user_id").agg(*home_columns(min_days))


def current_city(streaks: DataFrame, activity: str = "latest") -> DataFrame:
    """``user_id, act_city, last_action_time``: the city of the streak that ended last.

    The time is that of the user's latest action; ``activity='earliest'`` gives the earliest
    of the streaks' last actions instead.
    """
    return streaks.groupBy("user_id").agg(*current_columns(activity))


def travel_history(streaks: DataFrame) -> DataFrame:
    """``user_id, travel_count, travel_array``: cities in order of streak end.

    Adjacent repeats collapse. A trip inside a longer stay comes before that stay, as it
    ended first.
    """
    return with_travel_inputs(streaks).groupBy("user_id").agg(*travel_columns())
