"""Registered queries: every operator over the driver tables, and SQL to hold it against.

The queries derive the geo event log from all rows of ``events`` (``waymark.sources.testdata``)
and run the public operators over it. The home threshold is 4 days here, as the tables span
one month and hold no stay of 27 days. Timestamps are returned without time zone, in UTC or
the city's zone as the column says.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import uuid
from collections.abc import Callable
from functools import cached_property

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from waymark.functions.calendar import (  # noqa: E402
    first_timestamp,
    month_start,
    parse_timestamp,
    week_start,
)
from waymark.functions.distance import haversine_km, planar_km  # noqa: E402
from waymark.operators import activity, nearest, pairs, proximity, residence, streaks  # noqa: E402
from waymark.operators.messages import normalize_messages  # noqa: E402
from waymark.operators.sampling import estimated_counts, sample_users  # noqa: E402
from waymark.plans.friends import friends_mart  # noqa: E402
from waymark.plans.user_geo import user_geo_mart  # noqa: E402
from waymark.plans.zone import zone_mart  # noqa: E402
from waymark.schemas import CITY_CSV, MESSAGE_CITY, USER_GEO_MART  # noqa: E402
from waymark.session import prepare_session  # noqa: E402
from waymark.sources.bucketed import open_table, write_bucketed  # noqa: E402
from waymark.sources.cities import (  # noqa: E402
    BROKEN_LINE,
    city_rejects,
    clean_cities,
    known_cities,
    reject_reason,
    with_timezone,
)
from waymark.sources.events import events_window, ingest_events, read_events  # noqa: E402
from waymark.sources.testdata import geo_log  # noqa: E402

HOME_DAYS = 4
AS_OF = dt.datetime(2024, 2, 1, 12, 30, 0)
SYDNEY = (-33.865, 151.2094)


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


class _Inputs:
    """The stages of the data flow, derived from one directory of tables.

    All stages are lazy. Queries that use one of them more than once take the ``kept_`` form,
    which Spark persists when it is first computed, so that the log is matched with the cities
    once; the stages kept for the query before are let go.
    """

    _kept: list[DataFrame] = []

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare_session(spark)
        self.events = geo_log(spark, sf_dir)
        self.cities = known_cities(spark)
        while self._kept:
            self._kept.pop().unpersist()

    def _keep(self, df: DataFrame) -> DataFrame:
        self._kept.append(df.persist())
        return df

    @cached_property
    def messages(self) -> DataFrame:
        return normalize_messages(self.events)

    @cached_property
    def message_city(self) -> DataFrame:
        return nearest.message_city(self.events, self.cities)

    @cached_property
    def kept_message_city(self) -> DataFrame:
        return self._keep(self.message_city)

    @cached_property
    def streaks(self) -> DataFrame:
        return streaks.day_streaks(streaks.daily_presence(self.message_city))

    @cached_property
    def user_geo(self) -> DataFrame:
        return user_geo_mart(self.message_city, self.cities, HOME_DAYS)

    @cached_property
    def kept_user_geo(self) -> DataFrame:
        return self._keep(user_geo_mart(self.kept_message_city, self.cities, HOME_DAYS))

    @cached_property
    def near_pairs(self) -> DataFrame:
        members = pairs.channel_members(self.kept_user_geo, self.events)
        return proximity.near_pairs(
            self.kept_message_city, members, ["city", "channel"], keep=["city"]
        )


def _haversine_to_city(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    km = haversine_km(F.col("lat"), F.col("lon"), F.lit(SYDNEY[0]), F.lit(SYDNEY[1]))
    return at.events.select(F.col("event.message_id").alias("event_id"), F.round(km, 6).alias("km"))


def _planar_distance(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    km = planar_km(F.col("lat"), F.col("lon"), F.lit(SYDNEY[0]), F.lit(SYDNEY[1]))
    return at.events.select(F.col("event.message_id").alias("event_id"), F.round(km, 6).alias("km"))


def _nearest_city(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    found = nearest.assign_nearest(at.messages, at.cities, distance="km")
    return _ntz(found, "datetime").withColumns(
        {c: F.round(c, 6) for c in ("lat", "lon", "km")}
    )


def _nearest_place_many(spark, sf_dir):
    """Nearest of many places, one derived from each customer, to each message."""
    at = _Inputs(spark, sf_dir)
    key = F.col("c_custkey")
    places = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.concat(F.lit("place "), key).alias("city"),
        (-44 + key * 7919 % 34000 / 1000).alias("lat"),
        (113 + key * 104729 % 41000 / 1000).alias("lon"),
    )
    found = nearest.assign_nearest(at.messages, places)
    return found.select("message_id", "user_id", "city")


def _messages_per_city_day(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    return at.message_city.groupBy("city", "date").agg(F.count(F.lit(1)).alias("messages"))


def _city_timezone(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    per_city = at.message_city.groupBy("city").agg(F.count(F.lit(1)).alias("messages"))
    return with_timezone(per_city)


def _parse_city_csv(spark, sf_dir):
    """Parses a city list line per event: semicolon text with decimal commas."""
    prepare_session(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    event_id = F.col("event_id")
    decimals = lambda factor: F.lpad((event_id * factor % 10000).cast("string"), 4, "0")
    line = F.concat_ws(
        ";",
        event_id,
        F.when(event_id % 3 == 0, "Hobart").when(event_id % 3 == 1, "Gold Coast")
        .otherwise("Perth"),
        F.concat(F.lit("-"), 10 + event_id % 34, F.lit(","), decimals(7919)),
        F.concat(113 + event_id % 40, F.lit(","), decimals(104729)),
    )
    parsed = F.from_csv(line, CITY_CSV.simpleString()[7:-1].replace(":", " "), {"sep": ";"})
    return clean_cities(events.select(parsed.alias("line")).select("line.*"))


def _parse_timestamps(spark, sf_dir):
    prepare_session(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    event_id = F.col("event_id")
    text = (
        F.when(event_id % 5 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSSSSS"))
        .when(event_id % 5 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.S"))
        .when(event_id % 5 == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(event_id % 5 == 3, F.concat(F.lit("at "), F.date_format("ts", "HH:mm")))
    )
    day = F.col("ts").cast("date")
    parsed = events.select(
        "event_id",
        parse_timestamp(text).alias("parsed"),
        parse_timestamp(text, lenient=False).alias("parsed_strict"),
        first_timestamp([text], day).alias("parsed_or_date"),
    )
    return _ntz(parsed, "parsed", "parsed_strict", "parsed_or_date")


def _events_by_date_type(spark, sf_dir):
    """Ingests the log, with a field beyond its contract, into date/type directories of the
    warehouse and counts what is read back. The folder goes with the session."""
    at = _Inputs(spark, sf_dir)
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/geo_events_{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    wider = F.col("event").withField("message_channel_to", F.lit(None).cast("long"))
    ingest_events(at.events.withColumn("event", wider), path)
    return read_events(spark, path).groupBy("date", "event_type").agg(
        F.count(F.lit(1)).alias("events")
    )


def _events_window(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    week = events_window(at.events, "2024-01-14", 7)
    return week.select(F.col("event.message_id").alias("event_id"), "date", "event_type")


def _daily_presence(spark, sf_dir):
    return _ntz(streaks.daily_presence(_Inputs(spark, sf_dir).message_city), "datetime")


def _day_streaks(spark, sf_dir):
    return _ntz(_Inputs(spark, sf_dir).streaks, "last_action")


def _streaks_advanced(spark, sf_dir):
    """The runs of days, carried on over three stretches of the log one after another."""
    at = _Inputs(spark, sf_dir)
    presence = streaks.daily_presence(at.message_city)
    part = lambda n: presence.where(
        F.least(F.dayofmonth("date"), F.lit(29)).between(10 * n, 10 * n + 9)
    )
    state = streaks.day_streaks(part(0))
    for n in (1, 2):
        state = streaks.advance_streaks(state, part(n))
    return _ntz(state, "last_action")


def _home_city(spark, sf_dir):
    return residence.home_city(_Inputs(spark, sf_dir).streaks, HOME_DAYS)


def _current_city(spark, sf_dir):
    return _ntz(residence.current_city(_Inputs(spark, sf_dir).streaks), "last_action_time")


def _current_city_earliest(spark, sf_dir):
    found = residence.current_city(_Inputs(spark, sf_dir).streaks, activity="earliest")
    return _ntz(found, "last_action_time")


def _travel_history(spark, sf_dir):
    found = residence.travel_history(_Inputs(spark, sf_dir).streaks)
    return found.withColumn("travel_array", F.array_join("travel_array", ","))


def _user_geo_mart(spark, sf_dir):
    found = _Inputs(spark, sf_dir).user_geo
    return _ntz(found, "local_time").withColumn("travel_array", F.array_join("travel_array", ","))


def _event_actor_city(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    return activity.events_with_city(at.events, at.user_geo)


def _calendar_buckets(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    date = F.col("date")
    buckets = at.events.groupBy(
        date, week_start(date).alias("week"), month_start(date).alias("month")
    )
    return buckets.agg(F.count(F.lit(1)).alias("events"))


def _registrations(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    return activity.registrations(at.kept_message_city, at.kept_user_geo)


def _registrations_by_user(spark, sf_dir):
    """The registrations out of tables that are stored by user in the warehouse. The folders go
    with the session."""
    at = _Inputs(spark, sf_dir)
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    tables = []
    for name, df, schema in (
        ("message_city", at.message_city, MESSAGE_CITY),
        ("user_geo_mart", at.user_geo, USER_GEO_MART),
    ):
        path = f"{warehouse}/{name}_{uuid.uuid4().hex}"
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
        write_bucketed(df, path, buckets=8)
        tables.append(open_table(spark, path, schema, name))
    return activity.registrations(*tables)


def _activity_week(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    return activity.city_activity(at.events, at.user_geo)


def _activity_month(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    return activity.city_activity(at.events, at.user_geo, ("city", "month"), prefix="month_")


def _zone_mart(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    return zone_mart(at.events, at.kept_message_city, at.kept_user_geo)


def _shared_channel_pairs(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    return pairs.shared_channel_pairs(at.kept_user_geo, at.events)


def _shared_groups(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    return pairs.group_links(pairs.shared_groups(at.user_geo, at.events))


def _contact_edges(spark, sf_dir):
    return pairs.contact_edges(_Inputs(spark, sf_dir).events)


def _exclude_contacts(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    return pairs.exclude_contacts(at.near_pairs, pairs.contact_edges(at.events))


def _within_km(spark, sf_dir):
    """People who wrote to each other and came within 3 km."""
    at = _Inputs(spark, sf_dir)
    return proximity.within_km(pairs.direct_contacts(at.events), at.kept_message_city, 3.0)


def _within_km_haversine(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    contacts = pairs.direct_contacts(at.events)
    return proximity.within_km(contacts, at.kept_message_city, 3.0, metric="haversine")


def _near_pairs(spark, sf_dir):
    return _Inputs(spark, sf_dir).near_pairs


def _friends_mart(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    found = friends_mart(
        at.kept_user_geo, at.events, at.kept_message_city, at.cities, AS_OF
    )
    return _ntz(found, "local_time")


def _sample_users(spark, sf_dir):
    at = _Inputs(spark, sf_dir)
    return sample_users(at.user_geo, 0.4).select("user_id", "home_city", "act_city")


def _estimated_activity(spark, sf_dir):
    """Messages per city and day, estimated from the messages of a sample of the users."""
    at = _Inputs(spark, sf_dir)
    some = sample_users(at.message_city, 0.4, weight="weight")
    return estimated_counts(some, ["city", "date"]).withColumns(
        {c: F.round(c, 6) for c in ("estimate", "standard_error")}
    )


def _city_rejects(spark, sf_dir):
    """Counts the lines of a city list that cannot be used, a line per event, by reason."""
    prepare_session(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.col("event_id") % 8
    field = lambda bad, text, good: F.when(kind == bad, text).otherwise(good)
    line = F.concat_ws(
        ";",
        field(0, F.concat(F.lit("no "), "event_id"), F.col("event_id").cast("string")),
        field(1, F.lit(""), F.lit("Perth")),
        field(2, F.lit("-31,9,5"), F.lit("-31,95")),
        F.when(kind == 3, F.lit("115E86")).when(kind == 4, F.lit("NaN")).when(kind == 5, None)
        .otherwise("115,86"),
        F.when(kind == 6, F.lit("more")),
    )
    schema = f"id string, city string, lat string, lng string, {BROKEN_LINE} string"
    parsed = F.from_csv(line, schema, {"sep": ";", "columnNameOfCorruptRecord": BROKEN_LINE})
    judged = events.select(parsed.alias("line")).select("line.*")
    rejects = city_rejects(judged.withColumn("reason", reject_reason()))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


try:
    import corpus_pipeline
    from waymark.llm import registry as llm_registry
except ImportError:  # the library stands without its training-data operators
    _LLM_QUERIES, _LLM_ORACLES = {}, {}
else:
    _LLM_QUERIES = {**llm_registry.QUERIES, "pipeline": corpus_pipeline.run}
    _LLM_ORACLES = llm_registry.ORACLES


def entry(spark: SparkSession) -> DataFrame:
    """The user mart over the smallest tables."""
    return _user_geo_mart(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "haversine_to_city": _haversine_to_city,
        "planar_distance": _planar_distance,
        "nearest_city": _nearest_city,
        "nearest_place_many": _nearest_place_many,
        "messages_per_city_day": _messages_per_city_day,
        "city_timezone": _city_timezone,
        "parse_city_csv": _parse_city_csv,
        "parse_timestamps": _parse_timestamps,
        "events_by_date_type": _events_by_date_type,
        "events_window": _events_window,
        "daily_presence": _daily_presence,
        "day_streaks": _day_streaks,
        "streaks_advanced": _streaks_advanced,
        "home_city": _home_city,
        "current_city": _current_city,
        "current_city_earliest": _current_city_earliest,
        "travel_history": _travel_history,
        "user_geo_mart": _user_geo_mart,
        "event_actor_city": _event_actor_city,
        "calendar_buckets": _calendar_buckets,
        "registrations": _registrations,
        "registrations_by_user": _registrations_by_user,
        "activity_week": _activity_week,
        "activity_month": _activity_month,
        "zone_mart": _zone_mart,
        "shared_channel_pairs": _shared_channel_pairs,
        "shared_groups": _shared_groups,
        "contact_edges": _contact_edges,
        "exclude_contacts": _exclude_contacts,
        "within_km": _within_km,
        "within_km_haversine": _within_km_haversine,
        "near_pairs": _near_pairs,
        "friends_mart": _friends_mart,
        "sample_users": _sample_users,
        "estimated_activity": _estimated_activity,
        "city_rejects": _city_rejects,
        **_LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    from oracle_queries import ORACLES

    return {**ORACLES, **_LLM_ORACLES}
