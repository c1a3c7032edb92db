import datetime as dt
import math
import random
from pathlib import Path

import pytest
from conftest import final_plan, planned, rows
from pyspark.sql import functions as F

from waymark.functions.calendar import TIMESTAMP_FORMAT
from waymark.operators import nearest
from waymark.operators.messages import normalize_messages
from waymark.operators.nearest import assign_nearest, message_city
from waymark.operators.place_tree import FAN, build_tree

PLACES = "city string, lat double, lon double"
POINTS = "message_id long, user_id long, datetime timestamp, lat double, lon double"
NOON = dt.datetime(2024, 1, 1, 12)


def brute_force(points, places, metric):
    def spread(p, q):
        if metric == "planar":
            return math.hypot(p[0] - q[0], p[1] - q[1])
        a1, o1, a2, o2 = map(math.radians, (*p, *q))
        return (math.sin((a2 - a1) / 2) ** 2
                + math.cos(a1) * math.cos(a2) * math.sin((o2 - o1) / 2) ** 2)

    return [min((spread((lat, lon), (a, o)), city) for city, a, o in places)[1]
            for lat, lon in points]


def some_points(count, seed=7, box=((-60, 60), (-180, 180))):
    dice = random.Random(seed)
    return [(dice.uniform(*box[0]), dice.uniform(*box[1])) for _ in range(count)]


def assigned(spark, points, places, **options):
    frame = spark.createDataFrame(
        [(n, 1, NOON, lat, lon) for n, (lat, lon) in enumerate(points)], POINTS
    )
    found = assign_nearest(frame, spark.createDataFrame(places, PLACES), **options)
    return [city for _, city in rows(found, "message_id", "city")]


@pytest.mark.parametrize("metric", ["haversine", "planar"])
@pytest.mark.parametrize("count", [1, 24, 48, 49, 5000])
def test_equals_brute_force_for_short_and_long_lists(spark, metric, count):
    places = [(f"place {n}", *p) for n, p in enumerate(some_points(count, seed=count))]
    points = some_points(300)
    expected = brute_force(points, places, metric)
    for key in (None, nearest.MESSAGE_KEY):
        assert assigned(spark, points, places, metric=metric, key=key) == expected
    assert assigned(spark, points, places, metric=metric, list_places=3) == expected


@pytest.mark.parametrize("metric", ["haversine", "planar"])
def test_long_list_crowded_into_one_cell(spark, metric):
    """Most places in a single cell of half a degree, which is cut into smaller ones."""
    crowd = some_points(2000, seed=1, box=((10.01, 10.49), (20.01, 20.49)))
    places = [(f"place {n}", *p) for n, p in enumerate(crowd + some_points(20, seed=2))]
    points = some_points(200, seed=3, box=((9, 12), (19, 22))) + some_points(50, seed=4)
    assert assigned(spark, points, places, metric=metric) == brute_force(points, places, metric)


@pytest.mark.parametrize("metric", ["haversine", "planar"])
def test_tree_of_many_levels(spark, metric):
    """Two places to a list, crowds on one meridian and parallel, and points inside and out."""
    spots = some_points(150, seed=11, box=((-35, -33), (150, 152)))
    spots += [(-34.0, 151 + n / 1000) for n in range(60)]
    spots += [(-34 + n / 1000, 151.0) for n in range(60)]
    spots += [(-34.0 + n / 1e9, 151.0 + n / 1e9) for n in range(60)] + some_points(20, seed=12)
    places = [(f"place {n}", *p) for n, p in enumerate(spots)]
    points = some_points(200, seed=13, box=((-36, -32), (149, 153))) + some_points(50, seed=14)
    points += spots[::9]
    for key in (None, nearest.MESSAGE_KEY):
        found = assigned(spark, points, places, metric=metric, key=key, list_places=2)
        assert found == brute_force(points, places, metric)


def test_lists_of_a_crowd_are_short(spark):
    """40,000 places within a tenth of a degree, and points in the crowd and far from it."""
    dice = random.Random(21)
    spots = [(dice.uniform(10, 10.1), dice.uniform(20, 20.1)) for _ in range(40_000)]
    places = spark.createDataFrame([(f"place {n}", *p) for n, p in enumerate(spots)], PLACES)
    axes = dict(zip(nearest._AXES, nearest._axes(F.col("lat"), F.col("lon"), "haversine")))
    tree = build_tree(places.withColumns(axes), nearest._AXES, nearest.LIST_PLACES)
    sizes = [r.n for r in tree.leaves.select(F.size("places").alias("n")).collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= nearest.LIST_PLACES and len(tree.root) <= FAN
    assert max(r.n for r in tree.inner.select(F.size("children").alias("n")).collect()) <= FAN
    points = some_points(3_900, seed=22, box=((9.9, 10.2), (19.9, 20.2))) + some_points(100)
    frame = spark.createDataFrame([(n, 1, NOON, *p) for n, p in enumerate(points)], POINTS)
    found = dict(rows(assign_nearest(frame, places, key=None), "message_id", "city"))
    assert len(found) == 4_000
    for n in dice.sample(range(3_900), 40) + list(range(3_900, 4_000, 5)):
        assert found[n] == brute_force([points[n]], [
            (f"place {m}", *p) for m, p in enumerate(spots)], "haversine")[0]


def test_plans_gather_no_group(spark):
    """Neither a window nor a list over all places of some area."""
    text = (Path(nearest.__file__).parent / "place_tree.py").read_text()
    assert "Window" not in text
    places = [(f"place {n}", 5.0, 5.0 + n / 1e7) for n in range(300)]
    assert assigned(spark, [(5.0, 5.0)], places, list_places=10) == ["place 0"]


def test_long_list_over_the_date_line_and_poles(spark):
    places = [(f"place {n}", *p) for n, p in enumerate(
        some_points(80, seed=5, box=((-90, 90), (170, 180)))
        + some_points(40, seed=6, box=((80, 90), (-180, 180)))
    )]
    points = some_points(150, seed=8, box=((-90, 90), (-180, -175))) + [(90.0, 0.0), (-90.0, 0.0)]
    assert assigned(spark, points, places) == brute_force(points, places, "haversine")


@pytest.mark.parametrize("filler", [0, 70])
def test_ties_go_to_the_first_name(spark, filler):
    places = [("zeta", 0.0, 1.0), ("alpha", 0.0, -1.0), ("beta", 0.0, -1.0)]
    places += [(f"far {n}", 40.0 + n / 10, 90.0) for n in range(filler)]
    assert assigned(spark, [(0.0, 0.0)], places) == ["alpha"]


@pytest.mark.parametrize("filler", [0, 70])
def test_distance_of_the_chosen_place(spark, filler):
    places = [("here", 0.0, 0.0)] + [(f"far {n}", 40.0 + n / 10, 90.0) for n in range(filler)]
    points = spark.createDataFrame([(1, 1, NOON, 0.0, 90.0 / 8)], POINTS)
    found = assign_nearest(points, spark.createDataFrame(places, PLACES), distance="km").first()
    assert found.km == pytest.approx(math.pi * 6371.0 / 16)
    assert (found.city, found.lat, found.lon) == ("here", 0.0, 90.0 / 8)


@pytest.mark.parametrize("filler", [0, 70])
def test_places_and_points_without_coordinates_or_name(spark, filler):
    nan = float("nan")
    places = [("lost", None, 2.0), ("found", 50.0, 50.0), (None, 1.0, 1.0), ("odd", nan, 1.0)]
    places += [(f"far {n}", 70.0 + n / 10, 90.0) for n in range(filler)]
    points = [(1.0, 1.0), (nan, 1.0), (None, 1.0)]
    assert assigned(spark, points, places) == ["found"]
    assert assigned(spark, points, [("lost", None, None)]) == []
    assert assigned(spark, points, []) == []


def test_repeated_keys_keep_the_row_nearest_to_any_city(spark, log, cities):
    stamp = {"ts": "2024-01-01 10:00:00.0", "user": 5, "id": 1}
    events = log(
        {**stamp, "lat": -30.0, "lon": 150.0},
        {**stamp, "lat": -37.8, "lon": 144.96},
        {**stamp, "lat": -33.0, "lon": 151.0},
        {"ts": "2024-01-01 10:00:00.0", "user": 6, "id": 1, "lat": -31.9, "lon": 115.8},
        {"ts": "2024-01-01 10:00:00.0", "user": 7, "id": 2, "lat": None, "lon": 115.8},
        {"type": "reaction", "user": 5, "id": 3, "lat": -31.9, "lon": 115.8},
    )
    found = message_city(events, cities)
    assert rows(found, "message_id", "user_id", "city", "lat") == [
        (1, 5, "Melbourne", -37.8), (1, 6, "Perth", -31.9)
    ]


def test_message_fields(spark, log):
    assert TIMESTAMP_FORMAT.endswith("S" * 9)
    events = log(
        {"id": 1, "user": 2, "ts": "2024-01-05 01:02:03.5", "datetime": "2024-01-06 00:00:00.5"},
        {"id": 2, "user": 2, "datetime": "2024-01-06 00:00:00.5"},
        {"id": 3, "user": 2, "ts": "2024-01-06 00:00:00"},
        {"id": 4, "user": 2},
    )
    at = lambda df: [r.t for r in df.orderBy("message_id").selectExpr(
        "message_id", "date_format(datetime, 'dd HH:mm:ss') AS t").collect()]
    assert at(normalize_messages(events)) == [
        "05 01:02:03", "06 00:00:00", "06 00:00:00", "01 00:00:00"
    ]
    assert at(normalize_messages(events, lenient=False))[2] == "01 00:00:00"


@pytest.mark.parametrize("count", [24, 200])
def test_plan_has_no_nested_loop_and_sorts_the_points_once(spark, count):
    places = spark.createDataFrame(
        [(f"place {n}", *p) for n, p in enumerate(some_points(count))], PLACES
    )
    points = spark.range(1000).select(
        (F.col("id") * 7 % 1000).alias("message_id"), F.lit(1).alias("user_id"), F.lit(NOON).alias("datetime"),
        (F.rand(1) * 100 - 50).alias("lat"), (F.rand(2) * 100).alias("lon"),
    )
    unkeyed = final_plan(assign_nearest(points, places, key=None))
    keyed = planned(assign_nearest(points, places))
    for plan in (unkeyed, keyed):
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert "SinglePartition" not in plan
    # From the top: the window, its one sort, and the exchange on the key with none below it
    # up to the join with the leaves, if there are any.
    assert ("Join" in keyed) == (count > nearest.LIST_PLACES)
    assert count > nearest.LIST_PLACES or "Exchange" not in unkeyed
    upper = keyed[keyed.index("Window") : keyed.index("Join") if "Join" in keyed else None]
    assert upper.count("Exchange hashpartitioning(message_id") == 1
    below = upper[upper.index("Exchange hashpartitioning(message_id"):]
    assert "Sort [message_id" not in below and "SortAggregate" not in below
