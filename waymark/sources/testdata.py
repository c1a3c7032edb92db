"""Geo events out of a plain ``events`` table that has no coordinates.

Places, channels and addressees are arithmetic on ids and days, so that any engine derives
the same log from the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.events import MESSAGE, REACTION, SUBSCRIPTION
from waymark.schemas import GEO_EVENTS, check_schema
from waymark.sources.cities import known_cities


def geo_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``geo_events`` of the tables under ``sf_dir``, all rows."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    event_id, user_id = F.col("event_id"), F.col("user_id")
    day = F.col("ts").cast("date")
    kind = (
        F.when(F.col("event_type") == "click", REACTION)
        .when(F.col("event_type") == "purchase", SUBSCRIPTION)
        .otherwise(MESSAGE)
    )
    is_message = F.col("kind") == MESSAGE
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSSSSS")
    away = (F.dayofyear(day) + user_id) % 10 >= 7
    city_id = 1 + F.when(away, user_id + 3).otherwise(user_id) % 6
    rows = raw.select(
        "*", day.alias("date"), kind.alias("kind"), city_id.cast("int").alias("city_id")
    )
    cities = known_cities(spark).select(
        F.col("id").alias("city_id"), F.col("lat").alias("city_lat"), F.col("lon").alias("city_lon")
    )
    event = F.struct(
        event_id.alias("message_id"),
        F.when(is_message, user_id).alias("message_from"),
        F.when(
            is_message & (event_id % 30 == 0),
            user_id - user_id % 15 + (user_id * 7 + event_id) % 15,
        ).alias("message_to"),
        # The log stamps some events in one field and some in the other.
        F.when(event_id % 2 == 0, stamp).alias("message_ts"),
        F.when(event_id % 2 == 1, stamp).alias("datetime"),
        F.when(F.col("kind") == REACTION, user_id).alias("reaction_from"),
        F.when(F.col("kind") == SUBSCRIPTION, user_id).alias("user"),
        F.when(F.col("kind") == SUBSCRIPTION, event_id % 5).alias("subscription_channel"),
    )
    log = rows.join(cities, "city_id").select(
        event.alias("event"),
        (F.col("city_lat") + ((event_id * 7919) % 1001 - 500) / F.lit(1000.0)).alias("lat"),
        (F.col("city_lon") + ((event_id * 104729) % 1009 - 504) / F.lit(1000.0)).alias("lon"),
        "date",
        F.col("kind").alias("event_type"),
    )
    return check_schema(log, GEO_EVENTS, "geo_events")
