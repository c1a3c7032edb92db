"""Distance joins: pairs of users with any two of their points within a distance.

Points are summarised at two levels, as a bounding box per user and grid cell and, where that
is not enough, per user and part of a cell. The least and greatest distance of two boxes settle
most pairs: near if the greatest is within reach, far if the least is not. Boxes of a single
point leave nothing open. What is still open after the boxes of cells goes on to those of
parts, and what these leave open is settled by exact points. Nothing is rounded, so the result
equals that of comparing all points.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.distance import (
    EARTH_RADIUS_KM,
    KM_PER_DEGREE,
    metric_function,
    square,
    unit_sphere,
)
from waymark.functions.grid import Grid
from waymark.operators.blocks import BLOCK_ROWS, block_join, formed_without, without_edges
from waymark.operators.near_blocks import near_in_blocks
from waymark.sources.staging import staged

# Parts of a grid cell along each axis.
PARTS = 8
# Points of one box that meet those of another in one go.
BLOCK_POINTS = 1024

# Points of a user, and values of keys, that are held in one row.
MOST_POINTS = 20_000
MOST_KEYS = 64
# Points of a block of users, about.
BLOCK_SPOTS = 500_000
# Tasks for each core of the session.
_TASKS = 8

# Cells laid on one another, about, when all boxes look ahead.
_CELLS_AHEAD = 5

_PLACE = ("lat", "lon")
_SPHERE = ("x", "y", "z")


def _axes(metric: str) -> tuple[str, ...]:
    """Axes the bounds are taken along: degrees, and on the sphere space as well, where neither
    the date line nor a pole is special."""
    return _PLACE if metric == "planar" else _PLACE + _SPHERE


def _located(points: DataFrame) -> DataFrame:
    there = F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("user_id").isNotNull()
    return points.where(there).select("user_id", "lat", "lon")


def point_boxes(points: DataFrame, km: float, metric: str, parts: int = 1) -> DataFrame:
    """``user_id, cell``, with ``parts`` over one also ``part``, and the least and greatest of
    the user's points there along each axis, ``lat_lo, lat_hi, …``."""
    grid = Grid(km, metric)
    lat, lon = F.col("lat"), F.col("lon")
    located = _located(points)
    if metric != "planar":
        located = located.withColumns(dict(zip(_SPHERE, unit_sphere(lat, lon))))
    keys = [grid.cell(lat, lon).alias("cell")]
    if parts > 1:
        keys.append(grid.part(lat, lon, parts).alias("part"))
    ends = [
        of(axis).alias(f"{axis}_{end}")
        for axis in _axes(metric) for end, of in (("lo", F.min), ("hi", F.max))
    ]
    return located.groupBy("user_id", *keys).agg(*ends)


def reach(km: float, metric: str) -> tuple[Column, Column]:
    """Whether boxes of columns ``l_*`` and ``r_*`` can hold two points within the distance, and
    whether any two of their points surely are."""
    left = lambda name: F.col(f"l_{name}")
    right = lambda name: F.col(f"r_{name}")

    def gap(axis: str) -> Column:
        return F.greatest(
            F.lit(0.0),
            left(f"{axis}_lo") - right(f"{axis}_hi"),
            right(f"{axis}_lo") - left(f"{axis}_hi"),
        )

    def extent(axis: str) -> Column:
        return F.greatest(
            left(f"{axis}_hi") - right(f"{axis}_lo"), right(f"{axis}_hi") - left(f"{axis}_lo")
        )

    if metric == "planar":
        # The same steps as the planar distance, each of which keeps the order of its
        # arguments, so the bounds hold to the last bit.
        length = lambda of: F.sqrt(square(of("lat")) + square(of("lon"))) * KM_PER_DEGREE
        return length(gap) <= km, length(extent) <= km
    # Straight through the sphere two points are this far apart at the distance; the margin is
    # wider than what rounding does to it or to the great-circle formula.
    chord = 2 * math.sin(min(km / (2 * EARTH_RADIUS_KM), math.pi / 2))
    margin = 1e-9 * chord + 1e-14
    total = lambda of: square(of("x")) + square(of("y")) + square(of("z"))
    single = F.lit(True)
    for side in (left, right):
        for axis in _PLACE:
            single = single & (side(f"{axis}_lo") == side(f"{axis}_hi"))
    exact = metric_function(metric)(
        left("lat_lo"), left("lon_lo"), right("lat_lo"), right("lon_lo")
    ) <= km
    possible = total(gap) <= (chord + margin) ** 2
    sure = (total(extent) <= max(chord - margin, 0.0) ** 2) & F.lit(chord > margin)
    return F.when(single, exact).otherwise(possible), F.when(single, exact).otherwise(sure)


def _side(boxes: DataFrame, prefix: str) -> DataFrame:
    return boxes.select(*[F.col(c).alias(prefix + c) for c in boxes.columns])


def _settled(
    met: DataFrame, pair: Sequence[str], points: DataFrame, km: float, metric: str
) -> DataFrame:
    """The near pairs out of meetings of boxes of cells (``pair``, ``l_cell``, ``r_cell``, and
    ``near``: whether that one is sure)."""
    met = staged(met, "meetings")
    sure = met.where("near").select(*pair).distinct()
    boxes = ["l_cell", "r_cell"]
    still_open = met.where(~F.col("near")).select(*pair, *boxes).distinct().join(
        sure, list(pair), "left_anti"
    )
    if still_open.isEmpty():
        return sure
    fine = point_boxes(points, km, metric, PARTS)
    possible, certain = reach(km, metric)
    met = still_open.join(
        _side(fine, "l_").withColumnRenamed("l_user_id", "user_left"), ["user_left", "l_cell"]
    ).join(
        _side(fine, "r_").withColumnRenamed("r_user_id", "user_right"), ["user_right", "r_cell"]
    ).where(possible)
    boxes += ["l_part", "r_part"]
    met = staged(met.select(*pair, *boxes, certain.alias("near")), "meetings")
    also = met.where("near").select(*pair).distinct()
    still_open = met.where(~F.col("near")).select(*pair, *boxes).join(
        also, list(pair), "left_anti"
    )
    found = sure.unionByName(also)
    if still_open.isEmpty():
        return found
    return found.unionByName(_near_by_points(still_open, pair, points, km, metric))


def _near_by_points(
    still_open: DataFrame,
    pair: Sequence[str],
    points: DataFrame,
    km: float,
    metric: str,
    block_points: int = BLOCK_POINTS,
) -> DataFrame:
    """The pairs with two points within the distance in the boxes still open.

    How many points a box has is known before any meet, and a full box is dealt into blocks:
    each block of one box meets each of the other under a key of its own.
    """
    grid = Grid(km, metric)
    lat, lon = F.col("lat"), F.col("lon")
    spots = _located(points).select(
        "user_id", grid.cell(lat, lon).alias("cell"), grid.part(lat, lon, PARTS).alias("part"),
        "lat", "lon",
    )
    box = ["user_id", "cell", "part"]
    own = lambda side, user: still_open.select(
        F.col(user).alias("user_id"), F.col(f"{side}_cell").alias("cell"),
        F.col(f"{side}_part").alias("part"),
    )
    wanted = own("l", "user_left").unionByName(own("r", "user_right")).distinct()
    spots = spots.join(wanted, box, "left_semi").distinct()
    blocks = F.ceil(F.count(F.lit(1)) / block_points).cast("int").alias("blocks")
    per_box = spots.groupBy(*box).agg(blocks)
    dealt = spots.join(per_box, box).select(
        *box, F.pmod(F.xxhash64("lat", "lon"), "blocks").cast("int").alias("block"), "lat", "lon"
    )
    met = still_open
    for side, user in (("l", "user_left"), ("r", "user_right")):
        keys = {"user_id": user, "cell": f"{side}_cell", "part": f"{side}_part"}
        counts = per_box.withColumnsRenamed(keys)
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        met = met.join(counts, list(keys.values())).withColumn(f"{side}_block", every).drop("blocks")
    for side, user in (("l", "user_left"), ("r", "user_right")):
        keys = {
            "user_id": user, "cell": f"{side}_cell", "part": f"{side}_part",
            "block": f"{side}_block",
        }
        named = dealt.withColumnsRenamed({**keys, "lat": f"{side}_lat", "lon": f"{side}_lon"})
        met = met.join(named, list(keys.values()))
    apart = metric_function(metric)(
        F.col("l_lat"), F.col("l_lon"), F.col("r_lat"), F.col("r_lon")
    )
    return met.where(apart <= km).select(*pair).distinct()


def within_km(
    pairs: DataFrame,
    points: DataFrame,
    km: float = 1.0,
    metric: str = "planar",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The rows of ``pairs`` (``user_left, user_right, …``) with any two points within ``km``.

    ``points`` has ``user_id, lat, lon``. Only cells of the pair's own users are compared. A user
    in very many pairs, or in very many cells, is dealt into blocks on either side.
    """
    grid = Grid(km, metric)
    pair = ["user_left", "user_right"]
    there = F.col("user_left").isNotNull() & F.col("user_right").isNotNull()
    wanted = pairs.where(there).select(*pair).distinct()
    boxes = point_boxes(points, km, metric)
    probes = block_join(
        wanted.withColumnsRenamed({"user_left": "user_id", "user_right": "l_other"}),
        _side(boxes, "r_").withColumnRenamed("r_user_id", "user_id"),
        keys=["user_id"],
        spread={"l_": ["other"], "r_": ["cell"]},
        condition=F.lit(True),
        block_rows=block_rows,
    )
    # Around a box means around any of its corners, which lie in one cell.
    around = F.explode(grid.cells_around(F.col("r_lat_lo"), F.col("r_lon_lo")))
    ends = [f"{axis}_{end}" for axis in _axes(metric) for end in ("lo", "hi")]
    probes = probes.select(
        F.col("user_id").alias("user_left"), F.col("l_other").alias("user_right"),
        F.col("r_cell").alias("l_cell"), *[F.col(f"r_{e}").alias(f"l_{e}") for e in ends],
        around.alias("cell"),
    )
    # Boxes of a user in many pairs are met by that many probes: a copy for each block of pairs.
    n = F.count(F.lit(1))
    busy = wanted.groupBy("user_right").agg(n.alias("_n")).where(F.col("_n") > block_rows).select(
        "user_right", F.ceil(F.col("_n") / block_rows).cast("int").alias("_blocks")
    )
    blocks = F.coalesce("_blocks", F.lit(1))
    probes = probes.join(busy, "user_right", "left").withColumn(
        "_block", F.pmod(F.xxhash64("user_left"), blocks).cast("int")
    ).drop("_blocks")
    there = _side(boxes, "r_").withColumnsRenamed({"r_user_id": "user_right", "r_cell": "cell"})
    there = there.join(busy, "user_right", "left").withColumn(
        "_block", F.explode(F.sequence(F.lit(0), blocks - 1))
    ).drop("_blocks")
    possible, certain = reach(km, metric)
    met = probes.join(there, ["user_right", "cell", "_block"]).where(possible).select(
        *pair, "l_cell", F.col("cell").alias("r_cell"), certain.alias("near")
    )
    return pairs.join(_settled(met, pair, points, km, metric), pair, "left_semi")


def _cell_counts(placed: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int, int]:
    """Boxes per key and cell, what meetings they make about, and the most of them."""
    counts = placed.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("_n"))
    n = F.col("_n").cast("double")
    found = counts.agg(F.sum(n * n).alias("meetings"), F.max("_n").alias("most")).first()
    return counts, found["meetings"] or 0.0, found["most"] or 0


def near_pairs(
    points: DataFrame,
    members: DataFrame,
    keys: Sequence[str],
    km: float = 1.0,
    metric: str = "planar",
    keep: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``user_left, user_right``: pairs that share all of ``keys`` in some row of ``members``
    (``user_id`` and the keys) and have any two points within ``km``; the larger id on the left.
    Keys named in ``keep`` stay in the result, which then has a row per pair and value.

    The same pairs as forming all pairs that share the keys and then applying ``within_km``,
    but place is part of the search from the start, so pairs that share the keys and are far
    apart are never formed. Boxes are counted before they meet. Where the other keys part many
    of them, boxes meet under all keys. Else users are dealt into blocks under ``keep``, and all
    pairs of two blocks are found, held to the other keys and given out by one task, so that
    pairs are never moved. Users too large for a row meet the others box by box. What is asked
    for without the pairs of some edges (``exclude_contacts``) has them left out in these tasks.
    """
    others = [k for k in keys if k not in keep]
    boxes = point_boxes(points, km, metric)
    homes = members.where(F.col("user_id").isNotNull())
    for key in keys:
        homes = homes.where(F.col(key).isNotNull())
    wide = boxes.join(homes.select("user_id", *keep).distinct(), "user_id")
    if others:
        placed = boxes.join(members.select("user_id", *keys).distinct(), "user_id")
        counts, meetings, most = _cell_counts(placed, keys)
        _, wide_meetings, _ = _cell_counts(wide, keep)
        if wide_meetings >= meetings:
            pair = ["user_left", "user_right", *keep]
            met = _meetings(placed, list(keys), km, metric, counts, most, block_rows)
            return _settled(
                met.select(*pair, "l_cell", "r_cell", "near"), pair, points, km, metric
            )
    large = _large_users(points, homes, others)
    few = None if large is None else _near_large(
        points, wide, homes, large, keys, keep, km, metric, block_rows
    )

    def formed(edges: DataFrame | None) -> DataFrame:
        found = _near_in_blocks(points, homes, keep, others, large, km, metric, block_rows, edges)
        if few is None:
            return found
        return found.unionByName(few if edges is None else without_edges(few, edges))

    return formed_without(formed)


def _large_users(
    points: DataFrame, homes: DataFrame, others: Sequence[str]
) -> DataFrame | None:
    """``user_id`` of those with too many points or keys to be held in a row, if there are any."""
    n = F.count(F.lit(1)).alias("_n")
    large = _located(points).groupBy("user_id").agg(n).where(F.col("_n") > MOST_POINTS)
    large = large.select("user_id")
    if others:
        of_user = homes.select("user_id", *others).distinct().groupBy("user_id").agg(n)
        large = large.unionByName(of_user.where(F.col("_n") > MOST_KEYS).select("user_id"))
    large = staged(large.distinct(), "large")
    return None if large.isEmpty() else large


def _near_in_blocks(
    points: DataFrame,
    homes: DataFrame,
    keep: Sequence[str],
    others: Sequence[str],
    large: DataFrame | None,
    km: float,
    metric: str,
    block_rows: int,
    edges: DataFrame | None = None,
) -> DataFrame:
    """The near pairs of users that are not ``large``, but for those that one of the ``edges``
    connects: these go to the blocks their users are in, each to one task."""
    spots = _located(points)
    if large is not None:
        spots = spots.join(large, "user_id", "left_anti")
    spots = spots.groupBy("user_id").agg(F.collect_set(F.struct("lat", "lon")).alias("spots"))
    if len(others) == 1:
        value = F.col(others[0])
    else:
        value = F.to_json(F.struct(F.lit(0), *others))
    if not keep:
        homes = homes.withColumn("_all", F.lit(0))
    at = list(keep) or ["_all"]
    users = homes.groupBy("user_id", *at).agg(F.collect_set(value).alias("shared"))
    users = users.join(spots, "user_id")
    full = F.greatest(
        F.count(F.lit(1)) / block_rows, F.sum(F.size("spots")) / BLOCK_SPOTS
    )
    blocks = users.groupBy(*at).agg(F.ceil(full).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64("user_id"), "_blocks").cast("int")
    dealt = users.join(blocks, at).withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    ).select(
        *at, F.greatest("_own", "_other").alias("_l"), F.least("_own", "_other").alias("_r"),
        "_own", "user_id", "shared", F.col("spots.lat").alias("lat"), F.col("spots.lon").alias("lon"),
    )
    user = dealt.schema["user_id"].dataType.simpleString()
    spot = f"struct<other:{user},l_lat:double,l_lon:double,r_lat:double,r_lon:double>"
    kept = ", ".join(f"`{c}` {dealt.schema[c].dataType.simpleString()}" for c in at)
    check = bool(others)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        yield from near_in_blocks(rows, at, km, metric, check)

    if edges is not None:
        # Of pairs the larger id is on the left, so the other half of the edges meets none.
        known = edges.where(F.col("user_id") > F.col("contact_id")).select(
            "user_id", F.col("contact_id").alias("_contact")
        )
        of = homes.select("user_id", *at).distinct().join(blocks, at).select(
            "user_id", *at, own.alias("_own")
        )
        of_contact = of.withColumnsRenamed({"user_id": "_contact", "_own": "_theirs"})
        known = known.join(of, "user_id").join(of_contact, ["_contact", *at]).select(
            *at, F.greatest("_own", "_theirs").alias("_l"), F.least("_own", "_theirs").alias("_r"),
            "user_id", "_contact",
        )
        dealt = dealt.unionByName(known, allowMissingColumns=True)
    tasks = _TASKS * max(1, points.sparkSession.sparkContext.defaultParallelism)
    near = dealt.repartition(tasks, *at, "_l", "_r").groupBy(*at, "_l", "_r").applyInArrow(
        found, f"{kept}, one {user}, others array<{user}>, doubts array<{spot}>"
    )
    apart = metric_function(metric)
    measured = F.transform(
        F.filter("doubts", lambda d: apart(d["l_lat"], d["l_lon"], d["r_lat"], d["r_lon"]) <= km),
        lambda d: d["other"],
    )
    every = F.when(F.size("doubts") == 0, F.col("others")).otherwise(
        F.concat("others", F.array_distinct(measured))
    )
    near = near.select(*keep, "one", F.explode(every).alias("other"))
    return near.select(
        F.greatest("one", "other").alias("user_left"),
        F.least("one", "other").alias("user_right"), *keep,
    )


def _near_large(
    points: DataFrame,
    placed: DataFrame,
    homes: DataFrame,
    large: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str],
    km: float,
    metric: str,
    block_rows: int,
) -> DataFrame:
    """The near pairs in which either user is ``large``."""
    grid = Grid(km, metric)
    known = placed.join(large.withColumn("large", F.lit(True)), "user_id", "left")
    around = F.explode(grid.cells_around(F.col("lat_lo"), F.col("lon_lo")))
    side = lambda df, prefix, *more: df.select(
        *keep, *[F.col(c).alias(prefix + c) for c in placed.columns if c not in ("cell", *keep)],
        *more,
    )
    l_user, r_user = F.col("l_user_id"), F.col("r_user_id")
    once = F.when(F.col("large"), l_user > r_user).otherwise(l_user != r_user)
    possible, certain = reach(km, metric)
    met = block_join(
        side(known.where("large"), "l_", F.col("cell").alias("l_cell"), around.alias("cell")),
        side(known, "r_", "cell", "large"), keys=[*keep, "cell"],
        spread=["user_id", "lat_lo", "lon_lo"], condition=once & possible, block_rows=block_rows,
    )
    first, cell = l_user > r_user, F.col("cell")
    pair = ["user_left", "user_right", *keep]
    met = met.select(
        F.greatest(l_user, r_user).alias("user_left"),
        F.least(l_user, r_user).alias("user_right"), *keep,
        F.when(first, F.col("l_cell")).otherwise(cell).alias("l_cell"),
        F.when(first, cell).otherwise(F.col("l_cell")).alias("r_cell"),
        certain.alias("near"),
    )
    near = _settled(met, pair, points, km, metric)
    if len(keys) == len(keep):
        return near
    # Each key of the left person is looked up among those of the right one.
    mine = homes.select("user_id", *keys).distinct()
    left = mine.withColumnRenamed("user_id", "user_left")
    right = mine.withColumnRenamed("user_id", "user_right")
    return (
        near.join(left, ["user_left", *keep])
        .join(right, ["user_right", *keys], "left_semi")
        .select(*pair).distinct()
    )


def _meetings(
    placed: DataFrame, keys: Sequence[str], km: float, metric: str, counts: DataFrame,
    most: int, block_rows: int,
) -> DataFrame:
    """Boxes of different users that share the keys and can be within reach, once each."""
    grid = Grid(km, metric)
    ahead = grid.cells_around(F.col("lat_lo"), F.col("lon_lo"), forward=True)
    sides = {}
    for prefix, cells in (("l_", F.explode(ahead)), ("r_", F.col("cell"))):
        sides[prefix] = placed.select(
            *keys,
            *[F.col(c).alias(prefix + c) for c in placed.columns if c not in ("cell", *keys)],
            *([F.col("cell").alias("l_cell")] if prefix == "l_" else []),
            cells.alias("cell"),
        )
    l_user, r_user, cell = F.col("l_user_id"), F.col("r_user_id"), F.col("cell")
    possible, certain = reach(km, metric)
    # Two boxes of one cell meet both ways round, boxes of different cells once.
    once = F.when(F.col("l_cell") == cell, l_user > r_user).otherwise(l_user != r_user)
    # With so few boxes to a cell no key is in need of blocks.
    if most * _CELLS_AHEAD <= block_rows:
        met = sides["l_"].join(sides["r_"], [*keys, "cell"]).where(once & possible)
    else:
        met = block_join(
            sides["l_"], sides["r_"], keys=[*keys, "cell"],
            spread=["user_id", "lat_lo", "lon_lo"], condition=once & possible,
            block_rows=block_rows,
        )
    first = l_user > r_user
    return met.select(
        F.greatest(l_user, r_user).alias("user_left"),
        F.least(l_user, r_user).alias("user_right"),
        *keys,
        F.when(first, F.col("l_cell")).otherwise(cell).alias("l_cell"),
        F.when(first, cell).otherwise(F.col("l_cell")).alias("r_cell"),
        certain.alias("near"),
    )
