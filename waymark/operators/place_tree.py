"""A tree of places, cut by their count and never by area.

A node with too many places is cut into parts of about equal count, axis by axis at quantiles,
until each leaf holds a short list; a crowd in one spot only makes the tree deeper there. Nodes
know the box around their places. All of it is grouped aggregates and joins on node numbers: no
group is collected that is not bounded by the fan of a node or the length of a list.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from waymark.sources.staging import staged

# Children of a node at most.
FAN = 64
_ROOT = 1


@dataclass
class PlaceTree:
    """``places`` if these are few, all of them; else the children of the root, which are few,
    ``inner`` (``node, children``) for the nodes below that have children, ``leaves`` (``node,
    places``) for the others, and the number of levels."""

    places: list[Row] | None
    root: list[Row] | None = None
    inner: DataFrame | None = None
    leaves: DataFrame | None = None
    levels: int = 0


def build_tree(
    places: DataFrame, axes: Sequence[str], list_places: int, along: Sequence[str] | None = None
) -> PlaceTree:
    """The tree of ``places`` (the axes and whatever else a list is to hold), with boxes in the
    ``axes`` and cuts ``along`` some columns, the axes if not given.

    No two places may agree on all that is cut along, so that every crowd can be cut. Of few
    places, or none, the list is taken to the driver; of more, only the root's children are.
    """
    along = along or axes
    few = places.head(list_places + 1)
    if len(few) <= list_places:
        return PlaceTree(few)
    columns = places.columns
    box = [
        of(axis).alias(f"{axis}_{end}")
        for axis in axes for end, of in (("lo", F.min), ("hi", F.max))
    ]
    whole = F.count(F.lit(1)).alias("n")
    open_places = places.withColumn("node", F.lit(_ROOT).cast("long"))
    most = open_places.count()
    levels, leaf_places = [], []
    while most:
        cut, parts = open_places.withColumnRenamed("node", "parent"), _parts(most, along, list_places)
        cut = cut.withColumn("node", F.col("parent"))
        for axis in along:
            cut = _cut(cut, axis, parts)
        cut = staged(cut, "places")
        level = staged(cut.groupBy("parent", "node").agg(whole, *box), "nodes")
        levels.append(level)
        # Stops short of cutting for ever should nothing come off the largest node.
        before, most = most, level.agg(F.max("n")).first()[0]
        again = (F.col("n") > list_places) & F.lit(most < before)
        crowded = level.where(again).select("node")
        leaf_places.append(cut.join(crowded, "node", "left_anti").select("node", *columns))
        if most <= list_places or most >= before:
            break
        open_places = cut.join(crowded, "node", "left_semi").select("node", *columns)
    node = F.struct("node", *[f"{a}_{end}" for a in axes for end in ("lo", "hi")])
    root = [Row(**r["child"].asDict()) for r in levels[0].select(node.alias("child")).collect()]
    inner = None
    for level in levels[1:]:
        children = level.groupBy(F.col("parent").alias("node")).agg(
            F.collect_list(node).alias("children")
        )
        inner = children if inner is None else inner.unionByName(children)
    held = leaf_places[0]
    for more in leaf_places[1:]:
        held = held.unionByName(more)
    leaves = held.groupBy("node").agg(F.collect_list(F.struct(*columns)).alias("places"))
    return PlaceTree(
        None, root, staged(inner, "inner") if inner is not None else None,
        staged(leaves, "leaves"), len(levels),
    )


def _parts(most: int, along: Sequence[str], list_places: int) -> int:
    """Parts per axis: the largest node comes down to a list in as few levels as the fan
    allows, and these cut alike."""
    # Somewhat smaller than the limit, as quantiles only cut about evenly.
    lists = most / (0.75 * list_places)
    levels = max(1, math.ceil(math.log(lists) / math.log(FAN) - 1e-9))
    limit = int(FAN ** (1 / len(along)) + 1e-9)
    return max(2, min(limit, math.ceil(lists ** (1 / (levels * len(along))))))


def _cut(places: DataFrame, axis: str, parts: int) -> DataFrame:
    """Each node's places cut in parts of about equal count along an axis."""
    steps = [n / parts for n in range(1, parts)]
    edges = places.groupBy("node").agg(F.percentile_approx(axis, steps, 1000).alias("_edges"))
    below = F.size(F.filter("_edges", lambda edge: edge < F.col(axis)))
    placed = places.join(edges, "node")
    return placed.withColumn("node", F.col("node") * parts + below).drop("_edges")


def box_distance(box: Column, here: dict[str, Column]) -> Column:
    """Least squared distance of a point to anything in a box."""
    total = None
    for axis, at in here.items():
        gap = F.greatest(F.lit(0.0), box[f"{axis}_lo"] - at, at - box[f"{axis}_hi"])
        total = gap * gap if total is None else total + gap * gap
    return total
