"""User mart: home city, current city, travel history and local time of each user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.calendar import local_time
from waymark.operators.residence import (
    HOME_DAYS,
    current_columns,
    home_columns,
    travel_columns,
    with_home_inputs,
    with_travel_inputs,
)
from waymark.operators.streaks import daily_presence, day_streaks


def user_geo_mart(
    message_city: DataFrame,
    cities: DataFrame,
    min_days: int = HOME_DAYS,
    activity: str = "latest",
) -> DataFrame:
    """One row per user: ``user_id, home_city, travel_count, travel_array, local_time, act_city``.

    Two exchanges in all: one for the daily presence, spread over user, city and day, and one
    that brings a user's days together. ``local_time`` is the last action in the zone of the
    current city; see ``current_city`` for ``activity``. Messages of no user are left out.
    """
    known = message_city.where(F.col("user_id").isNotNull())
    streaks = day_streaks(daily_presence(known))
    users = (
        with_travel_inputs(with_home_inputs(streaks))
        .groupBy("user_id")
        .agg(*home_columns(min_days), *current_columns(activity), *travel_columns())
    )
    zones = cities.select(F.col("city").alias("act_city"), "timezone")
    return users.join(zones, "act_city").select(
        "user_id",
        "home_city",
        "travel_count",
        "travel_array",
        local_time(F.col("last_action_time"), F.col("timezone")).alias("local_time"),
        "act_city",
    )
