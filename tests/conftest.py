import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from waymark import schemas  # noqa: E402
from waymark.sources.cities import known_cities  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("waymark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cities(spark):
    return known_cities(spark)


@pytest.fixture(scope="session")
def log(spark):
    """Builds a geo event log out of short event tuples."""

    def build(*events):
        rows = []
        for number, given in enumerate(events):
            row = {
                "id": number, "type": "message", "user": None, "to": None, "ts": None,
                "datetime": None, "channel": None, "lat": None, "lon": None,
                "date": dt.date(2024, 1, 1), **given,
            }
            kind, user = row["type"], row["user"]
            rows.append((
                (
                    row["id"],
                    user if kind not in ("reaction", "subscription") else None,
                    row["to"],
                    row["ts"],
                    row["datetime"],
                    user if kind == "reaction" else None,
                    user if kind == "subscription" else None,
                    row["channel"],
                ),
                row["lat"], row["lon"], row["date"], kind,
            ))
        return spark.createDataFrame(rows, schemas.GEO_EVENTS)

    return build


@pytest.fixture(scope="session")
def stays(spark):
    """Builds ``message_city`` rows out of (user, city, date[, time]) tuples."""

    def build(*rows):
        full = []
        for number, (user, city, day, *time) in enumerate(rows):
            at = time[0] if time else dt.time(12, 0)
            full.append((number, user, dt.datetime.combine(day, at), city, 0.0, 0.0, day))
        return spark.createDataFrame(full, schemas.MESSAGE_CITY)

    return build


def days(first, count):
    return [first + dt.timedelta(days=n) for n in range(count)]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def final_plan(df):
    """The executed plan as text, after adaptive execution has settled it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()
