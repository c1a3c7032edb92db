"""The city dimension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.schemas import CITY_CSV, CITY_DIM, check_schema

# Zone area and default zone of cities without a zone of their own.
ZONE_AREA = "Australia"
DEFAULT_ZONE = "Australia/Sydney"

# The public tz database names in that area.
AREA_ZONES = (
    "ACT", "Adelaide", "Brisbane", "Broken_Hill", "Canberra", "Currie", "Darwin", "Eucla",
    "Hobart", "LHI", "Lindeman", "Lord_Howe", "Melbourne", "NSW", "North", "Perth",
    "Queensland", "South", "Sydney", "Tasmania", "Victoria", "West", "Yancowinna",
)

# Id, name, latitude and longitude of the cities events are assigned to.
CITIES = (
    (1, "Sydney", -33.865, 151.2094),
    (2, "Melbourne", -37.8136, 144.9631),
    (3, "Brisbane", -27.4678, 153.0281),
    (4, "Perth", -31.9522, 115.8589),
    (5, "Adelaide", -34.9289, 138.6011),
    (6, "Gold Coast", -28.0167, 153.4),
    (7, "Cranbourne", -38.0996, 145.2834),
    (8, "Canberra", -35.2931, 149.1269),
    (9, "Newcastle", -32.9167, 151.75),
    (10, "Wollongong", -34.4331, 150.8831),
    (11, "Geelong", -38.15, 144.35),
    (12, "Hobart", -42.8806, 147.325),
    (13, "Townsville", -19.2564, 146.8183),
    (14, "Ipswich", -27.6167, 152.7667),
    (15, "Cairns", -16.9303, 145.7703),
    (16, "Toowoomba", -27.5667, 151.95),
    (17, "Darwin", -12.4381, 130.8411),
    (18, "Ballarat", -37.55, 143.85),
    (19, "Bendigo", -36.75, 144.2667),
    (20, "Launceston", -41.4419, 147.145),
    (21, "Mackay", -21.1411, 149.1861),
    (22, "Rockhampton", -23.375, 150.5117),
    (23, "Maitland", -32.7167, 151.55),
    (24, "Bunbury", -33.3333, 115.6333),
)


def city_zone(
    city: Column,
    default: str = DEFAULT_ZONE,
    overrides: Mapping[str, str] | None = None,
) -> Column:
    """Zone of a city: an override, else the area's zone of that name, else the default.

    The zone list is short and fixed, so this is a literal set test and needs no join.
    """
    own = F.concat(F.lit(f"{ZONE_AREA}/"), city)
    known = [f"{ZONE_AREA}/{name}" for name in AREA_ZONES]
    zone = F.when(own.isin(known), own).otherwise(F.lit(default))
    for name, other in (overrides or {}).items():
        zone = F.when(city == name, F.lit(other)).otherwise(zone)
    return zone


def with_timezone(
    cities: DataFrame,
    default: str = DEFAULT_ZONE,
    overrides: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ``timezone``. Many cities share their state capital's zone but have none of their
    own name; they get the default unless ``overrides`` (city to zone) says better."""
    return cities.withColumn("timezone", city_zone(F.col("city"), default, overrides))


def clean_cities(
    raw: DataFrame,
    default: str = DEFAULT_ZONE,
    overrides: Mapping[str, str] | None = None,
) -> DataFrame:
    """City rows as read from text: decimal commas to doubles, ``lng`` to ``lon``, plus zone."""
    number = lambda name: F.replace(F.col(name), F.lit(","), F.lit(".")).try_cast("double")
    numeric = raw.select("id", "city", number("lat").alias("lat"), number("lng").alias("lon"))
    return check_schema(with_timezone(numeric, default, overrides), CITY_DIM, "city_dim")


# What the parser puts a whole line into that has too many or too few fields.
BROKEN_LINE = "_line"


def reject_reason() -> Column:
    """Why a line of the city list, its fields read as text, cannot be used: ``fields`` (too
    many or too few), or the first of ``id``, ``city``, ``lat``, ``lon`` that is empty or not a
    number; NULL for a sound line."""
    number = lambda name: F.replace(F.col(name), F.lit(","), F.lit(".")).try_cast("double")
    finite = lambda value: value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return (
        F.when(F.col(BROKEN_LINE).isNotNull(), "fields")
        .when(F.col("id").try_cast("int").isNull(), "id")
        .when(F.coalesce(F.trim("city"), F.lit("")) == "", "city")
        .when(~finite(number("lat")), "lat")
        .when(~finite(number("lng")), "lon")
    )


def judged_lines(spark: SparkSession, path: str) -> DataFrame:
    """The fields of the city list as text, the line where these are too many or too few, and
    ``reason``. The header names the columns, which may come in any order and among others."""
    names = spark.read.csv(path, sep=";", header=True).columns
    missing = [f.name for f in CITY_CSV if f.name not in names]
    if missing:
        raise ValueError(f"city list lacks columns {', '.join(missing)}")
    schema = ", ".join(f"`{name}` string" for name in (*names, BROKEN_LINE))
    # All columns are parsed, whichever are asked for: else fields too many go unnoticed.
    reader = spark.read.option("columnPruning", False)
    lines = reader.csv(
        path, schema=schema, sep=";", header=True, columnNameOfCorruptRecord=BROKEN_LINE
    )
    return lines.withColumn("reason", reject_reason())


def city_rejects(judged: DataFrame) -> DataFrame:
    """``line, reason`` of the lines that cannot be used, with the fields put together again
    where the line was not kept."""
    fields = F.concat_ws(";", *[F.coalesce(f.name, F.lit("")) for f in CITY_CSV])
    return judged.where(F.col("reason").isNotNull()).select(
        F.coalesce(BROKEN_LINE, fields).alias("line"), "reason"
    )


def load_cities(
    spark: SparkSession,
    path: str,
    default: str = DEFAULT_ZONE,
    overrides: Mapping[str, str] | None = None,
    rejects: str | None = None,
) -> DataFrame:
    """Read the city list: ``;`` between fields, decimal commas, any line end. The header
    names the columns, which may come in any order and among others. Lines that cannot be used
    are left out, and written to ``rejects`` with the reason if that is given."""
    judged = judged_lines(spark, path)
    if rejects:
        city_rejects(judged).write.mode("overwrite").parquet(rejects)
    sound = judged.where(F.col("reason").isNull())
    raw = sound.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in CITY_CSV])
    return clean_cities(raw, default, overrides)


def known_cities(spark: SparkSession) -> DataFrame:
    """The built-in city list as a city dimension.

    Written as VALUES, so Spark knows its exact size and broadcasts it on its own.
    """
    rows = ", ".join(f"({i}, '{city}', {lat}D, {lon}D)" for i, city, lat, lon in CITIES)
    listed = spark.sql(f"SELECT * FROM VALUES {rows} AS city (id, city, lat, lon)")
    return with_timezone(listed)
