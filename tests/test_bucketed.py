"""Tables stored by user: the same rows, and plans without an exchange of the stored side."""

import pytest
from conftest import planned, rows
from pyspark.sql import functions as F

from waymark import schemas
from waymark.jobs import cities as cities_job
from waymark.jobs import events, friends, message_city, user_geo, zones
from waymark.operators.activity import city_activity, first_seen
from waymark.operators.nearest import message_city as match_cities
from waymark.plans.user_geo import user_geo_mart
from waymark.session import join_by_user
from waymark.sources.bucketed import open_table, stored_buckets, write_bucketed
from waymark.sources.cities import CITIES
from waymark.sources.testdata import geo_log

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def by_user(spark):
    """A session that joins by user, with sides too large to broadcast."""
    before = {k: spark.conf.get(k) for k in (
        "spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.enabled",
    )}
    join_by_user(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def test_stored_rows_are_the_same(spark, cities, tmp_path):
    path = str(tmp_path / "messages")
    messages = match_cities(geo_log(spark, SF), cities)
    for n in (4, 2):  # the second write takes the place of the first
        write_bucketed(messages, path, buckets=n)
        assert stored_buckets(spark, path) == ("user_id", n)
        found = open_table(spark, path, schemas.MESSAGE_CITY, "message_city")
        assert rows(found) == rows(messages)
        assert rows(spark.read.parquet(path)) == rows(messages)
    plain = str(tmp_path / "plain")
    messages.write.parquet(plain)
    assert stored_buckets(spark, plain) is None
    assert rows(open_table(spark, plain, schemas.MESSAGE_CITY, "message_city")) == rows(messages)
    with pytest.raises(ValueError):
        open_table(spark, plain, schemas.USER_GEO_MART, "user_geo_mart")
    write_bucketed(messages.limit(0), path, buckets=3)
    assert open_table(spark, path, schemas.MESSAGE_CITY, "message_city").count() == 0


def test_stored_sides_are_not_exchanged(by_user, cities, tmp_path):
    log = geo_log(by_user, SF)
    messages = match_cities(log, cities)
    at = lambda name: str(tmp_path / name)
    write_bucketed(messages, at("messages"), buckets=4)
    write_bucketed(user_geo_mart(messages, cities, 4), at("users"), buckets=4)
    stored = open_table(by_user, at("messages"), schemas.MESSAGE_CITY, "message_city")
    users = open_table(by_user, at("users"), schemas.USER_GEO_MART, "user_geo_mart")
    # First seen: grouped by user and city, and joined on both, without any exchange.
    plan = planned(first_seen(stored, users))
    assert "Exchange" not in plan and "Join" in plan and plan.count("Bucketed: true") == 2
    assert rows(first_seen(stored, users)) == rows(first_seen(messages, user_geo_mart(messages, cities, 4)))
    # Activity: the counts per user come to the users, who stay where they are.
    plan = planned(city_activity(log, users))
    join = plan[plan.index("Join"):]
    assert join.count("Bucketed: true") == 1
    right = join[: join.index("Bucketed: true")].rsplit("Sort", 1)[-1]
    assert "Exchange" not in right
    # The mart's one exchange by user is spared as well.
    plan = planned(user_geo_mart(stored, cities, 4))
    assert "Exchange hashpartitioning(user_id" not in plan


def test_jobs_on_stored_tables_give_the_same_marts(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    comma = lambda number: str(number).replace(".", ",")
    lines = [f"{i};{city};{comma(lat)};{comma(lon)}" for i, city, lat, lon in CITIES]
    (tmp_path / "cities.csv").write_text("\n".join(["id;city;lat;lng", *lines, "x;y"]) + "\n")
    geo_log(spark, "/root/testdata/sf0.01").write.parquet(at("raw"))
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    cities_job.main([at("cities.csv"), at("cities"), "--rejects", at("rejects")])
    assert rows(spark.read.parquet(at("rejects"))) == [("x;y", "fields")]
    events.main([at("raw"), at("events")])
    message_city.main([
        at("cities"), at("events"), at("messages"), "--by-user", at("by_user"), "--buckets", "5"
    ])
    for name, source, more in (("users", "messages", []), ("users_by", "by_user", ["--buckets", "5"])):
        user_geo.main([at(source), at("cities"), at(name), "--home-days", "4", *more])
    for users, source, suffix in (("users", "messages", ""), ("users_by", "by_user", "_by")):
        zones.main([at(users), at("events"), at(source), at("zones" + suffix)])
        friends.main([
            at(users), at("events"), at(source), at("cities"), at("friends" + suffix),
            "--as-of", "2024-02-01T12:00:00",
        ])
    text = lambda name: rows(spark.read.parquet(at(name)).select(F.to_json(F.struct("*"))))
    assert text("zones") == text("zones_by") and text("friends") == text("friends_by")
    assert len(text("friends")) > 100
    spark.conf.set(key, before)
