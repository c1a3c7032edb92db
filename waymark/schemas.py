"""Typed contracts of the tables, and the check applied when one is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CITY_CSV = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("city", T.StringType()),
    T.StructField("lat", T.StringType()),
    T.StructField("lng", T.StringType()),
])

CITY_DIM = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("city", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("timezone", T.StringType()),
])

GEO_EVENTS = T.StructType([
    T.StructField("event", T.StructType([
        T.StructField("message_id", T.LongType()),
        T.StructField("message_from", T.LongType()),
        T.StructField("message_to", T.LongType()),
        T.StructField("message_ts", T.StringType()),
        T.StructField("datetime", T.StringType()),
        T.StructField("reaction_from", T.LongType()),
        T.StructField("user", T.LongType()),
        T.StructField("subscription_channel", T.LongType()),
    ])),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("date", T.DateType()),
    T.StructField("event_type", T.StringType()),
])

MESSAGE_CITY = T.StructType([
    T.StructField("message_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("datetime", T.TimestampType()),
    T.StructField("city", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("date", T.DateType()),
])

USER_GEO_MART = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("home_city", T.StringType()),
    T.StructField("travel_count", T.LongType()),
    T.StructField("travel_array", T.ArrayType(T.StringType())),
    T.StructField("local_time", T.TimestampType()),
    T.StructField("act_city", T.StringType()),
])

ZONE_MART = T.StructType(
    [
        T.StructField("month", T.DateType()),
        T.StructField("city", T.StringType()),
        T.StructField("week", T.DateType()),
    ]
    + [
        T.StructField(f"{period}_{what}", T.LongType())
        for period in ("week", "month")
        for what in ("message", "reaction", "subscription", "user")
    ]
)

FRIENDS_MART = T.StructType([
    T.StructField("user_left", T.LongType()),
    T.StructField("user_right", T.LongType()),
    T.StructField("processed_dttm", T.DateType()),
    T.StructField("zone_id", T.IntegerType()),
    T.StructField("local_time", T.TimestampType()),
])


def _faults(found: T.StructType, wanted: T.StructType, path: str = "") -> list[str]:
    """Fields of ``wanted`` that ``found`` lacks or has with another type, at any depth."""
    there = {f.name: f.dataType for f in found}
    faults = []
    for field in wanted:
        at, kind = path + field.name, there.get(field.name)
        if kind is None:
            faults.append(f"{at}: missing")
        elif isinstance(field.dataType, T.StructType) and isinstance(kind, T.StructType):
            faults += _faults(kind, field.dataType, f"{at}.")
        elif kind.simpleString() != field.dataType.simpleString():
            faults.append(
                f"{at}: {kind.simpleString()}, expected {field.dataType.simpleString()}"
            )
    return faults


def check_schema(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Return ``df`` cut to the contract's columns, or raise naming every field at fault.

    Columns and fields of structs are found by name, in any order. Columns beyond the contract
    are cut off; fields beyond it stay in their struct, where scans leave out what is not used.
    Nullability is not compared: every Parquet column is read back as nullable.
    """
    faults = _faults(df.schema, schema)
    if faults:
        raise ValueError(f"{name} breaks its contract: " + "; ".join(faults))
    return df.select(*schema.names)
