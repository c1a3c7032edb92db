"""Friends mart: people to suggest to each other."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.calendar import local_time, utc_literal
from waymark.operators.blocks import BLOCK_ROWS
from waymark.operators.pairs import channel_members, contact_edges, exclude_contacts
from waymark.operators.proximity import near_pairs


def friends_mart(
    user_geo: DataFrame,
    events: DataFrame,
    message_city: DataFrame,
    cities: DataFrame,
    as_of: dt.datetime | None = None,
    km: float = 1.0,
    metric: str = "planar",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``user_left, user_right, processed_dttm, zone_id, local_time``, a row per pair.

    Pairs share a channel and the home city, have any two messages within ``km`` of each
    other and never wrote to each other. ``as_of`` (UTC, now if not given) dates the run and
    gives the local time in the home city. ``metric='haversine'`` measures east-west
    distances truly; the planar default overstates them away from the equator.
    """
    members = channel_members(user_geo, events)
    near = near_pairs(
        message_city, members, ["city", "channel"], km, metric, ["city"], block_rows
    )
    friends = exclude_contacts(near, contact_edges(events))
    now = utc_literal(as_of) if as_of else F.current_timestamp()
    zones = cities.select("city", F.col("id").alias("zone_id"), "timezone")
    return (
        friends.join(zones, "city")
        .select(
            "user_left",
            "user_right",
            F.to_date(now).alias("processed_dttm"),
            "zone_id",
            local_time(now, F.col("timezone")).alias("local_time"),
        )
    )
