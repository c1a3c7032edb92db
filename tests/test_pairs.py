import datetime as dt
import math
import random

import pytest
from conftest import final_plan, planned, rows
from pyspark.sql import functions as F

from waymark import schemas
from waymark.functions.distance import unit_sphere
from waymark.operators.blocks import block_join
from waymark.operators.pairs import (
    channel_members,
    contact_edges,
    direct_contacts,
    exclude_contacts,
    expand_groups,
    group_links,
    shared_channel_pairs,
    shared_groups,
)
from waymark.operators.proximity import (
    PARTS,
    _near_by_points,
    near_pairs,
    point_boxes,
    reach,
    within_km,
)
from waymark.plans.friends import friends_mart

AS_OF = dt.datetime(2024, 1, 1, 20, 0)


@pytest.fixture(scope="module")
def homes(spark):
    def build(*pairs):
        return spark.createDataFrame(
            [(u, city, 1, [city], None, city) for u, city in pairs], schemas.USER_GEO_MART
        )

    return build


@pytest.fixture(scope="module")
def points(spark):
    def build(*rows_):
        return spark.createDataFrame(rows_, "user_id long, lat double, lon double")

    return build


def follow(user, channel):
    return {"type": "subscription", "user": user, "channel": channel}


def test_pairs_share_channel_and_home(homes, log):
    users = homes((1, "A"), (2, "A"), (3, "B"), (4, "A"), (5, None), (6, None))
    events = log(
        follow(1, 10), follow(2, 10), follow(1, 11), follow(2, 11), follow(2, 10),
        follow(3, 10), follow(4, 12), follow(5, 10), follow(6, 10), follow(1, None), follow(4, None),
    )
    assert rows(shared_channel_pairs(users, events)) == [(2, 1, "A")]


def test_groups_stand_for_all_their_pairs(homes, log):
    users = homes(*[(n, "AB"[n % 2]) for n in range(1, 41)], (50, None), (51, "C"))
    events = log(*[follow(n, n % 3) for n in range(1, 41)], *[follow(n, 9) for n in range(1, 41, 2)],
                 follow(50, 9), follow(51, 9), follow(1, 9), follow(2, None))
    groups = shared_groups(users, events)
    assert len(rows(groups)) == 40 + 20  # a row per member, however many pairs
    expected = {(a, b, "AB"[a % 2]) for a in range(1, 41) for b in range(1, a)
                if a % 2 == b % 2 and (a % 3 == b % 3 or a % 2)}
    assert set(rows(expand_groups(groups))) == expected
    links = {(r.channel, r.city): (r.members, r.links) for r in group_links(groups).collect()}
    assert links[(9, "B")] == (20, 190) and (9, "C") not in links


def test_contacts_both_ways(log):
    events = log(
        {"user": 1, "to": 2}, {"user": 2, "to": 1}, {"user": 3, "to": 1}, {"user": 4, "to": 0},
        {"user": 5, "to": None}, {"user": 6, "to": 6}, {"user": None, "to": 7},
        {"type": "reaction", "user": 1, "to": 9},
    )
    assert rows(direct_contacts(events)) == [(2, 1), (3, 1), (6, 6)]
    assert rows(contact_edges(events)) == [(1, 2), (1, 3), (2, 1), (3, 1), (6, 6)]


def test_known_contacts_are_left_out_whoever_wrote(spark, log):
    pairs = spark.createDataFrame([(2, 1), (3, 1), (3, 2)], "user_left long, user_right long")
    edges = contact_edges(log({"user": 1, "to": 2}, {"user": 3, "to": 1}))
    assert rows(exclude_contacts(pairs, edges)) == [(3, 2)]


@pytest.mark.parametrize("block_rows", [3, 10, 1000])
def test_block_join_meets_every_pair_once(spark, block_rows):
    """Half of all rows share one key."""
    side = lambda prefix, count: spark.range(count).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 7).alias("k"),
        F.col("id").alias(f"{prefix}id"),
    )
    left, right = side("l_", 80), side("r_", 50)
    plain = left.join(right, "k").where("l_id > r_id")
    blocked = block_join(left, right, ["k"], ["id"], F.expr("l_id > r_id"), block_rows)
    assert rows(blocked, "l_id", "r_id") == rows(plain, "l_id", "r_id")


@pytest.mark.parametrize("block_rows", [1, 7, 1000])
def test_ordered_blocks_meet_every_pair_once(spark, block_rows):
    """Blocks by value, of which only the upper triangle meets; more than a hundred of them."""
    side = lambda prefix: spark.range(300).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 7).alias("k"),
        F.floor(F.col("id") / 2).alias(f"{prefix}id"),
    )
    left, right = side("l_"), side("r_")
    plain = left.join(right, "k").where("l_id > r_id")
    blocked = block_join(
        left, right, ["k"], ["id"], F.expr("l_id > r_id"), block_rows, ordered=True
    )
    assert rows(blocked, "l_id", "r_id") == rows(plain, "l_id", "r_id")


@pytest.mark.parametrize("block_rows", [2, 4096])
def test_hot_channel_in_blocks_gives_the_same_pairs(homes, log, block_rows):
    users = homes(*[(n, "A") for n in range(1, 31)])
    events = log(*[follow(n, 1) for n in range(1, 31)], follow(1, 2), follow(2, 2))
    expected = sorted((a, b, "A") for a in range(1, 31) for b in range(1, a))
    assert rows(shared_channel_pairs(users, events, block_rows)) == expected


def test_hot_channel_is_spread_over_partitions(homes, log):
    """All members share one channel and city, yet no partition joins more than its part."""
    users = homes(*[(n, "A") for n in range(1, 301)])
    events = log(*[follow(n, 1) for n in range(1, 301)])
    members = channel_members(users, events)
    side = lambda p: members.select("channel", "city", F.col("user_id").alias(f"{p}user_id"))
    joined = block_join(
        side("l_"), side("r_"), ["channel", "city"], ["user_id"], F.lit(True), block_rows=30
    )
    per_left = joined.groupBy(F.pmod(F.xxhash64("l_user_id"), F.lit(10)).alias("b")).count()
    assert joined.count() == 300 * 300 and per_left.count() == 10


def brute_near(points, metric, km):
    def apart(p, q):
        if metric == "planar":
            return math.sqrt((p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2) * 111
        a1, o1, a2, o2 = map(math.radians, (p[1], p[2], q[1], q[2]))
        h = (math.sin((a2 - a1) / 2) ** 2
             + math.cos(a1) * math.cos(a2) * math.sin((o2 - o1) / 2) ** 2)
        return 2 * 6371.0 * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))

    return {(p[0], q[0]) for p in points for q in points if p[0] > q[0] and apart(p, q) <= km}


@pytest.mark.parametrize("metric", ["planar", "haversine"])
@pytest.mark.parametrize("where", ["town", "crowd", "date line"])
def test_both_distance_joins_equal_brute_force(spark, points, metric, where):
    dice = random.Random(f"{metric}{where}")
    if where == "town":
        spots = [(dice.randrange(60), -33.8 + dice.uniform(-0.05, 0.05),
                  151.2 + dice.uniform(-0.05, 0.05)) for _ in range(300)]
    elif where == "crowd":  # few users with many points in a few squares, so boxes are full
        at = [(-33.8 + dice.uniform(-0.02, 0.02), 151.2 + dice.uniform(-0.02, 0.02))
              for _ in range(30)]
        spots = [(u, lat + dice.uniform(-0.002, 0.002), lon + dice.uniform(-0.002, 0.002))
                 for u, (lat, lon) in enumerate(at) for _ in range(30)]
    else:
        spots = [(dice.randrange(60), -16.5 + dice.uniform(-0.04, 0.04),
                  (179.98 + dice.uniform(0, 0.04) + 180) % 360 - 180) for _ in range(300)]
    frame = points(*spots)
    expected = brute_near(spots, metric, 1.0)
    ids = sorted({s[0] for s in spots})
    every = spark.createDataFrame(
        [(a, b) for a in ids for b in ids if a > b], "user_left long, user_right long"
    )
    assert set(rows(within_km(every, frame, 1.0, metric))) == expected
    members = spark.createDataFrame([(u, 1) for u in ids], "user_id long, k int")
    for block_rows in (20, 4096):
        found = rows(near_pairs(frame, members, ["k"], 1.0, metric, block_rows=block_rows))
        assert len(found) == len(set(found)) and set(found) == expected
    assert 0 < len(expected) < every.count()


@pytest.mark.parametrize("metric", ["planar", "haversine"])
@pytest.mark.parametrize("parts_of", ["channels", "few"])
def test_keys_that_part_few_are_checked_afterwards(spark, points, metric, parts_of):
    """The same pairs whether boxes meet under all keys or under the kept one alone."""
    dice = random.Random(parts_of)
    spots = [(dice.randrange(40), -33.8 + dice.uniform(-0.03, 0.03),
              151.2 + dice.uniform(-0.03, 0.03)) for _ in range(200)]
    n = 200 if parts_of == "channels" else 3
    rows_ = [(u, "AB"[u % 2] if u % 9 else None, k) for u in range(40)
             for k in [*dice.sample(range(n), 2), None]]
    members = spark.createDataFrame(rows_, "user_id long, city string, k int")
    shared = {(a, b, c) for a, c, k in rows_ for b, d, m in rows_
              if a > b and c and c == d and k is not None and k == m}
    near = brute_near(spots, metric, 1.0)
    found = rows(near_pairs(points(*spots), members, ["city", "k"], 1.0, metric, ["city"]))
    assert found == sorted((a, b, c) for a, b, c in shared if (a, b) in near)
    assert found or n == 200


@pytest.mark.parametrize("seed", range(4))
def test_boxes_on_the_sphere_bound_every_pair_of_points(spark, points, seed):
    """At the date line, the poles and elsewhere, for boxes from a metre to the whole globe."""
    dice = random.Random(seed)
    spots, expected = [], {}
    for n in range(150):
        at = dice.choice([(0, 180), (89.999, 0), (-90, 40), (-33.8, 151.2), (60, -179.999)])
        wide = 10 ** dice.uniform(-5, 1.7)
        for user in (2 * n, 2 * n + 1):
            lat = [min(90.0, max(-90.0, at[0] + dice.uniform(-wide, wide))) for _ in range(4)]
            lon = [(at[1] + dice.uniform(-wide, wide) + 180) % 360 - 180 for _ in range(4)]
            spots += [(user, *p) for p in zip(lat, lon)]
    located = points(*spots)
    space = located.withColumns(dict(zip("xyz", unit_sphere(F.col("lat"), F.col("lon")))))
    box = space.groupBy("user_id").agg(*[
        of(a).alias(f"{a}_{end}") for a in ("lat", "lon", "x", "y", "z")
        for end, of in (("lo", F.min), ("hi", F.max))
    ])
    side = lambda prefix, odd: box.where(F.col("user_id") % 2 == odd).select(
        F.floor(F.col("user_id") / 2).alias("n"), *[F.col(c).alias(prefix + c) for c in box.columns]
    )
    own = {}
    for user, lat, lon in spots:
        own.setdefault(user, []).append((user, lat, lon))
    for km in (0.001, 1.0, 700.0, 15_000.0):
        possible, sure = reach(km, "haversine")
        judged = side("l_", 0).join(side("r_", 1), "n").select(
            "n", possible.alias("possible"), sure.alias("sure")).collect()
        for r in judged:
            met = [len(brute_near([p, q], "haversine", km)) for p in own[2 * r.n]
                   for q in own[2 * r.n + 1]]
            assert r.possible or not any(met)
            assert not r.sure or all(met)


def test_one_pair_with_very_many_points_is_spread(spark, points):
    """Two people, 20,000 points each in one box of either: no task compares them all."""
    side = 1.001 / 111
    box = side / 8
    spots = [(u, (0.1 + 0.8 * (n % 200) / 200) * box + (u - 1) * 6 * box,
              (0.1 + 0.8 * (n // 200) / 100) * box) for u in (1, 2) for n in range(20_000)]
    frame = points(*spots)
    pair = spark.createDataFrame([(2, 1)], "user_left long, user_right long")
    own = point_boxes(frame, 1.0, "planar", PARTS).collect()
    assert len(own) == 2
    still_open = spark.createDataFrame(
        [(2, 1, *(r[c] for u in (2, 1) for r in own if r.user_id == u for c in ("cell", "part")))],
        "user_left long, user_right long, l_cell long, l_part long, r_cell long, r_part long",
    )
    for km in (5.2 * box * 111, 5.21 * box * 111):
        # Near enough or not, the blocks of either side meet under keys of their own.
        found = _near_by_points(still_open, ["user_left", "user_right"], frame, 1.0, "planar", 512)
        assert "r_block" in planned(found) and "l_block" in planned(found)
        apart = 6 * box - 0.8 * box * 199 / 200
        wanted = rows(pair) if apart * 111 <= km else []
        assert rows(within_km(pair, frame, km)) == wanted
    assert "NestedLoop" not in final_plan(found) and "Cartesian" not in final_plan(found)


@pytest.mark.parametrize("block_rows", [3, 4096])
def test_people_in_very_many_pairs(spark, points, block_rows):
    """Everybody is paired with one person, on either side."""
    dice = random.Random(block_rows)
    spots = [(u, -33.8 + dice.uniform(-0.03, 0.03), 151.2 + dice.uniform(-0.03, 0.03))
             for u in range(60) for _ in range(3)]
    pairs = [(30, u) for u in range(30)] + [(u, 30) for u in range(31, 60)] + [(5, None)]
    frame = spark.createDataFrame(pairs, "user_left long, user_right long")
    near = brute_near(spots, "planar", 1.0)
    found = rows(within_km(frame, points(*spots), block_rows=block_rows))
    assert found == sorted(p for p in pairs if p in near) and found


def test_one_kilometre_line(spark, points):
    degree = 1 / 111
    frame = points((1, 0.0, 0.0), (2, 0.99 * degree, 0.0), (3, 0.0, -1.01 * degree), (4, None, 0.0))
    pairs = spark.createDataFrame(
        [(2, 1, "x"), (3, 1, "y"), (4, 1, "z")], "user_left long, user_right long, note string"
    )
    assert rows(within_km(pairs, frame)) == [(2, 1, "x")]


def test_boxes_alone_do_not_decide(spark, points):
    """Two users' boxes come within reach of each other while their points do not."""
    cell = 1.001 / 111
    box = cell / 8
    left = [(1, 0.05 * box, 0.05 * box), (1, 0.95 * box, 0.95 * box)]
    right = [(2, 0.95 * box, 7.9 * box), (2, 0.05 * box, 7.95 * box)]
    frame = points(*left, *right)
    for reach in (6.955, 6.945, 6.5, 7.5):
        km = reach * box * 111
        expected = brute_near(left + right, "planar", km)
        every = spark.createDataFrame([(2, 1)], "user_left long, user_right long")
        assert set(rows(within_km(every, frame, km))) == expected


def test_a_user_with_most_points_counts_once_per_square(spark, points):
    busy = points(*[(1, 0.0001 + n * 1e-9, 0.0001) for n in range(5000)], (2, 0.0, 0.0))
    assert point_boxes(busy, 1.0, "planar").count() == 2


def friends_inputs(spark, homes, log):
    users = homes((1, "Perth"), (2, "Perth"), (3, "Perth"), (4, "Perth"), (5, "Hobart"), (6, "Perth"))
    events = log(
        *[follow(n, 1) for n in (1, 2, 3, 4, 5)], follow(6, 2),
        {"user": 3, "to": 1}, {"user": 2, "to": 0},
    )
    at = dt.datetime(2024, 1, 1)
    messages = spark.createDataFrame(
        [(n, u, at, "Perth", lat, lon, at.date()) for n, (u, lat, lon) in enumerate([
            (1, -32.0, 115.0), (2, -32.0, 115.005), (3, -32.001, 115.0), (4, -32.5, 115.0),
            (5, -32.0, 115.0), (6, -32.0, 115.0), (2, -10.0, 115.0),
        ])],
        schemas.MESSAGE_CITY,
    )
    return users, events, messages


def test_friends_mart(spark, homes, log, cities):
    users, events, messages = friends_inputs(spark, homes, log)
    mart = friends_mart(users, events, messages, cities, AS_OF)
    assert mart.columns == schemas.FRIENDS_MART.names
    found = mart.withColumn("local_time", F.col("local_time").cast("string"))
    day = dt.date(2024, 1, 1)
    assert rows(found) == [
        (2, 1, day, 4, "2024-01-02 04:00:00"), (3, 2, day, 4, "2024-01-02 04:00:00")
    ]


def test_friends_mart_equals_its_steps(spark, homes, log, cities):
    users, events, messages = friends_inputs(spark, homes, log)
    strangers = exclude_contacts(shared_channel_pairs(users, events), contact_edges(events))
    steps = within_km(strangers, messages)
    for metric in ("planar", "haversine"):
        mart = friends_mart(users, events, messages, cities, AS_OF, metric=metric)
        steps = within_km(strangers, messages, metric=metric)
        assert rows(mart, "user_left", "user_right") == rows(steps, "user_left", "user_right")


def test_as_of_is_utc_on_a_host_of_another_zone(spark, homes, log, cities, monkeypatch):
    import time

    users, events, messages = friends_inputs(spark, homes, log)
    monkeypatch.setenv("TZ", "Australia/Sydney")
    time.tzset()
    try:
        mart = friends_mart(users, events, messages, cities, AS_OF)
        found = mart.select(F.col("local_time").cast("string").alias("t"), "processed_dttm").first()
    finally:
        monkeypatch.undo()
        time.tzset()
    assert found.t == "2024-01-02 04:00:00" and found.processed_dttm == dt.date(2024, 1, 1)


def test_friends_mart_dates_itself_without_as_of(spark, homes, log, cities):
    users, events, messages = friends_inputs(spark, homes, log)
    found = friends_mart(users, events, messages, cities).first()
    now = dt.datetime.now(dt.timezone.utc).date()
    assert abs((found.processed_dttm - now).days) <= 1


def test_no_cartesian_product_anywhere(spark, homes, log, cities):
    users, events, messages = friends_inputs(spark, homes, log)
    for df in (
        friends_mart(users, events, messages, cities, AS_OF),
        shared_channel_pairs(users, events),
    ):
        plan = final_plan(df)
        assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("block_rows", [2, 8, 4096])
def test_pairs_of_followers_are_formed_once_and_not_made_distinct(homes, log, block_rows):
    """Many share all of their channels, some a few; some follow more than one row may hold."""
    dice = random.Random(block_rows)
    users = [(n, "AB"[n % 2]) for n in range(60)] + [(3, "A"), (3, "B")]
    follows = {(n, k) for n in range(60) for k in (range(5) if n % 3 else dice.sample(range(9), 2))}
    events = log(*[follow(n, k) for n, k in sorted(follows)])
    made = {(a, b, c) for a, c in users for b, d in users if a > b and c == d
            and any((a, k) in follows and (b, k) in follows for k in range(9))}
    found = shared_channel_pairs(homes(*users), events, block_rows)
    assert rows(found) == sorted(made)
    last = final_plan(found).split("Generate", 1)[0]
    assert "Exchange" not in last and "HashAggregate" not in last
    busy = [follow(n, k) for n in (7, 9, 20) for k in range(3 + n % 2, 80)]
    more = {(n, k) for n in (7, 9, 20) for k in range(3 + n % 2, 80)} | follows
    made = {(a, b, c) for a, c in users for b, d in users if a > b and c == d
            and any((a, k) in more and (b, k) in more for k in range(80))}
    events = log(*[follow(n, k) for n, k in sorted(follows)], *busy)
    assert rows(shared_channel_pairs(homes(*users), events, block_rows)) == sorted(made)


@pytest.mark.parametrize("metric", ["planar", "haversine"])
def test_near_pairs_are_found_in_blocks_and_never_moved(spark, points, monkeypatch, metric):
    """Small and large users, boxes of one and of many points, and pairs just at the distance."""
    dice = random.Random(metric)
    spots = [(u, -33.8 + dice.uniform(-0.03, 0.03), 151.2 + dice.uniform(-0.03, 0.03))
             for u in range(30) for _ in range(1 + u % 4)]
    spots += [(u, lat + dice.uniform(-0.0006, 0.0006), lon) for u, lat, lon in spots[::2] * 3]
    spots += [(40, 0.0, 10.0), (41, 0.0, 10.0 + math.degrees(1.0 / 6371.0)), (42, 0.0, float("nan")),
              (43, 1.0, 10.0), (44, 1.0 + 1 / 111, 10.0), (None, 0.0, 10.0)]
    rows_ = [(u, "A", k) for u in range(45) for k in range(3) if u % 5 or k]
    members = spark.createDataFrame(rows_, "user_id long, city string, k int")
    expected = {(*p, "A") for p in brute_near([s for s in spots if s[0] is not None], metric, 1.0)}
    near = lambda rows_: near_pairs(
        points(*spots), members, ["city", "k"], 1.0, metric, ["city"], rows_
    )
    for block_rows in (7, 4096):
        found = near(block_rows)
        assert rows(found) == sorted(expected)
        above = final_plan(found).split("FlatMapGroupsInArrow", 1)[0]
        assert "Exchange" not in above and "HashAggregate" not in above
    for limit in ("MOST_POINTS", "MOST_KEYS"):
        with monkeypatch.context() as patch:
            patch.setattr(f"waymark.operators.proximity.{limit}", 8 if limit == "MOST_POINTS" else 2)
            assert rows(near(4096)) == sorted(expected)


@pytest.mark.parametrize("metric", ["planar", "haversine"])
def test_contacts_are_left_out_in_blocks_and_no_pair_is_moved(spark, points, monkeypatch, metric):
    dice = random.Random(metric)
    spots = [(u, -33.8 + dice.uniform(-0.02, 0.02), 151.2 + dice.uniform(-0.02, 0.02))
             for u in range(30) for _ in range(1 + u % 4)]
    # Two at the distance to the last bit, where blocks leave the points to be measured.
    spots += [(40, 0.0, 10.0), (41, 0.0, 10.0 + math.degrees(1.0 / 6371.0)), (43, 1.0, 10.0),
              (44, 1.0 + 1 / 111, 10.0), (45, 1.0, 10.001)]
    rows_ = [(u, city, k) for u in range(50) for city in "AB"[: 1 + (u % 7 == 0)] for k in range(3)
             if u % 5 or k]
    members = spark.createDataFrame(rows_, "user_id long, city string, k int")
    near = lambda rows_: near_pairs(
        points(*spots), members, ["city", "k"], 1.0, metric, ["city"], rows_
    )
    every = rows(near(4096))
    met = sorted({(a, b) for a, b, _ in every})
    known = {p for n, p in enumerate(met) if n % 3 == 0} | {(41, 40), (45, 43), (44, 7), (60, 2)}
    edges = [*known, *[(b, a) for a, b in known], (3, 3), *list(known)[:5]]
    # An edge one way only, the other way than pairs are given, meets none.
    edges += [(b, a) for a, b in met[1:2]] + [(None, 5), (5, None)]
    edges = spark.createDataFrame(edges, "user_id long, contact_id long")
    wanted = [p for p in every if p[:2] not in known]
    assert 0 < len(wanted) < len(every) and any(p[2] == "B" for p in every)
    for block_rows in (7, 4096):
        found = exclude_contacts(near(block_rows), edges)
        assert rows(found) == wanted
        above = final_plan(found).split("FlatMapGroupsInArrow", 1)[0]
        assert "Exchange" not in above and "Join" not in above
    # Pairs that were changed after they were found are joined.
    changed = near(4096).where(F.col("user_left") > 3)
    assert rows(exclude_contacts(changed, edges)) == [p for p in wanted if p[0] > 3]
    with monkeypatch.context() as patch:
        patch.setattr("waymark.operators.proximity.MOST_POINTS", 8)
        assert rows(exclude_contacts(near(7), edges)) == wanted
