import datetime as dt

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from waymark import schemas
from waymark.operators.activity import (
    activity_pivot,
    city_activity,
    events_with_city,
    registrations,
)
from waymark.plans.zone import zone_mart

D = dt.date


@pytest.fixture(scope="module")
def users(spark):
    def build(**cities):
        return spark.createDataFrame(
            [(int(u[1:]), city, 1, [city], None, city) for u, city in cities.items()],
            schemas.USER_GEO_MART,
        )

    return build


def test_events_land_in_the_actors_current_city(log, users):
    events = log(
        {"id": 1, "user": 1}, {"id": 2, "type": "reaction", "user": 2},
        {"id": 3, "type": "subscription", "user": 1}, {"id": 4, "user": 99},
    )
    found = events_with_city(events, users(u1="A", u2="B"))
    assert rows(found, "message_id", "city") == [(1, "A"), (2, "B"), (3, "A")]


def test_other_event_types_change_nothing(log, users):
    known = [{"user": 1}, {"type": "reaction", "user": 1}]
    events, more = log(*known), log(*known, {"type": "login", "user": 1, "date": D(2024, 3, 3)})
    names = ["city", "month", "m_message", "m_reaction", "m_subscription"]
    counts = lambda e: activity_pivot(
        events_with_city(e, users(u1="A")), ["city", "month"], prefix="m_"
    )
    assert counts(more).columns == names
    assert counts(more).collect() == counts(events).collect() == [("A", D(2024, 1, 1), 1, 1, None)]
    zeros = activity_pivot(
        events_with_city(more, users(u1="A")), ["city"], fill_zero=True, types=["subscription", "message"]
    )
    assert zeros.collect() == [("A", 0, 1)]


def test_counting_before_the_join_equals_counting_after(spark, users):
    from waymark.sources.testdata import geo_log

    events = geo_log(spark, "/root/testdata/sf0.001")
    people = users(**{f"u{n}": "ABC"[n % 3] for n in range(12)})
    keys = ["city", "week", "month"]
    before = city_activity(events, people)
    after = activity_pivot(events_with_city(events, people), keys, prefix="week_")
    assert rows(before.fillna(-1)) == rows(after.fillna(-1), *before.columns)
    assert before.count() > 5


def test_registration_is_the_first_message_in_the_current_city(stays, users):
    frame = stays(
        (1, "B", D(2024, 1, 1)), (1, "A", D(2024, 1, 30)), (1, "A", D(2024, 2, 20)),
        (2, "A", D(2024, 2, 1)), (3, "B", D(2024, 1, 1)),
    )
    found = registrations(frame, users(u1="A", u2="A", u3="A"))
    week = D(2024, 1, 28)
    assert rows(found) == [("A", week, D(2024, 1, 1), 1), ("A", week, D(2024, 2, 1), 1)]


def test_a_week_over_two_months_stays_two_rows(log, stays, users):
    events = log(
        {"user": 1, "date": D(2024, 1, 30)}, {"user": 2, "date": D(2024, 2, 1)},
        {"user": 2, "date": D(2024, 2, 2)}, {"user": 2, "type": "reaction", "date": D(2024, 2, 9)},
    )
    messages = stays(
        (1, "A", D(2024, 1, 30)), (2, "A", D(2024, 2, 1)), (2, "A", D(2024, 2, 2))
    )
    mart = zone_mart(events, messages, users(u1="A", u2="A"))
    assert mart.columns == schemas.ZONE_MART.names
    jan, feb, week, next_week = D(2024, 1, 1), D(2024, 2, 1), D(2024, 1, 28), D(2024, 2, 4)
    assert sorted(map(tuple, mart.collect()), key=str) == [
        (jan, "A", week, 1, None, None, 1, 1, None, None, 1),
        (feb, "A", week, 2, None, None, 1, 2, 1, None, 1),
        (feb, "A", next_week, None, 1, None, None, 2, 1, None, 1),
    ]
    filled = zone_mart(events, messages, users(u1="A", u2="A"), fill_zero=True)
    assert filled.where("month = '2024-01-01'").first()[4:6] == (0, 0)


def test_weeks_add_up_to_their_month(spark, stays, users):
    from waymark.sources.testdata import geo_log

    events = geo_log(spark, "/root/testdata/sf0.001")
    messages = stays(*[(n, "A", D(2024, 1, 5)) for n in range(15)])
    mart = zone_mart(events, messages, users(**{f"u{n}": "A" for n in range(15)}))
    for kind in ("message", "reaction", "subscription"):
        sums = mart.groupBy("city", "month", f"month_{kind}").agg(F.sum(f"week_{kind}").alias("s"))
        assert all(r[f"month_{kind}"] == r.s for r in sums.collect())


def test_log_is_shuffled_only_as_counts(spark, users):
    """The join with users comes after the counting, also for a user with most of the log."""
    from waymark.sources.testdata import geo_log

    events = geo_log(spark, "/root/testdata/sf0.001")
    lines = final_plan(city_activity(events, users(u1="A"))).splitlines()
    shuffles = [n for n, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert shuffles
    for n in shuffles:
        assert "HashAggregate" in lines[n + 1]


def test_a_user_with_most_of_the_log_is_split_by_the_join(spark, tmp_path):
    """One user holds nine in ten events; adaptive execution cuts that partition."""
    path = str(tmp_path / "events")
    (
        spark.range(0, 400_000, 1, 8)
        .select(
            F.struct(
                F.col("id").alias("message_id"),
                F.when(F.col("id") % 10 == 0, F.col("id") % 1000).otherwise(7).alias("message_from"),
                F.lit(None).cast("long").alias("reaction_from"),
                F.lit(None).cast("long").alias("user"),
            ).alias("event"),
            F.lit("message").alias("event_type"),
            F.lit(D(2024, 1, 1)).alias("date"),
        )
        .write.parquet(path)
    )
    people = spark.range(1000).select(F.col("id").alias("user_id"), F.lit("A").alias("act_city"))
    kept = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in kept}
    try:
        for k, v in kept.items():
            spark.conf.set(k, v)
        found = events_with_city(spark.read.parquet(path), people)
        assert "skew=true" in final_plan(found)
        assert found.count() == 400_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
