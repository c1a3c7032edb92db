"""Nearest-place assignment.

Which place is nearest is decided on a quantity that orders places exactly as the distance
does but needs no trigonometry per pair: the squared straight-line chord between points on
the unit sphere for the great-circle metric, the squared offset in degrees for the planar.

Few places are one list, which every point is held against. More of them form a tree whose
leaves are short lists (``waymark.operators.place_tree``), and each point looks twice. It first
goes down to the nearest box at every level and finds the nearest place of that leaf, whose
distance bounds the result. It then visits all leaves whose box is no farther than that. The
work follows points and the few leaves around each, wherever places crowd.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from waymark.functions.distance import metric_function, square, unit_sphere
from waymark.operators.messages import normalize_messages
from waymark.operators.place_tree import PlaceTree, box_distance, build_tree

# Places in a list at most; with more there is a tree.
LIST_PLACES = 64

_AXES = ("_x", "_y", "_z")
MESSAGE_KEY = ("message_id", "user_id", "datetime")


def _axes(lat: Column, lon: Column, metric: str) -> list[Column]:
    """Coordinates in which the squared Euclidean distance orders like ``metric``."""
    if metric == "planar":
        return [lat, lon]
    return unit_sphere(lat, lon)


def _spread(here: Sequence[Column], there: Sequence[Column]) -> Column:
    total = square(here[0] - there[0])
    for a, b in zip(here[1:], there[1:]):
        total = total + square(a - b)
    return total


def _on_map() -> Column:
    finite = [
        F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
        for c in ("lat", "lon")
    ]
    return finite[0] & finite[1]


def _literal(rows: Sequence[Row], kinds: dict[str, str]) -> Column:
    """A bounded list of rows as an array of structs."""
    return F.array(*[
        F.struct(*[F.lit(r[name]).cast(kind).alias(name) for name, kind in kinds.items()])
        for r in rows
    ])


def _nearest_of(places: str | Column, names: Sequence[str]) -> Column:
    """Of a list of places the nearest to the point, with its ``spread``; then the first by
    name and coordinates."""
    here = [F.col(n) for n in names]
    return F.array_min(F.transform(
        places,
        lambda place: F.struct(
            _spread(here, [place[n] for n in names]).alias("spread"),
            place["city"].alias("city"), place["lat"].alias("lat"), place["lon"].alias("lon"),
        ),
    ))


def _by_list(points: DataFrame, places: Sequence[Row], names: Sequence[str]) -> DataFrame:
    kinds = {"city": "string", "lat": "double", "lon": "double", **dict.fromkeys(names, "double")}
    if not places:
        return points.where(F.lit(False)).withColumn(
            "_best", F.lit(None).cast("struct<spread:double,city:string,lat:double,lon:double>")
        )
    return points.withColumn("_best", _nearest_of(_literal(places, kinds), names))


def _by_tree(points: DataFrame, tree: PlaceTree, names: Sequence[str]) -> DataFrame:
    """Points with the nearest place of every leaf that can hold the nearest of all."""
    here = {n: F.col(n) for n in names}
    ends = [f"{n}_{end}" for n in names for end in ("lo", "hi")]
    root = _literal(tree.root, {"node": "long", **dict.fromkeys(ends, "double")})
    nearest_box = lambda children: F.array_min(F.transform(
        children,
        lambda c: F.struct(box_distance(c, here).alias("far"), c["node"].alias("node")),
    ))["node"]
    # What is computed per point goes through a generator, so that filters which the optimiser
    # infers for the joins do not compute it once more.
    once = lambda value: F.explode(F.array(value))
    found = points.withColumn("node", once(nearest_box(root)))
    for _ in range(1, tree.levels):
        deeper = F.coalesce(nearest_box(F.col("children")), F.col("node"))
        found = found.join(tree.inner, "node", "left").withColumn("node", once(deeper))
        found = found.drop("children")
    spread = lambda place: _spread(list(here.values()), [place[n] for n in names])
    found = found.join(tree.leaves, "node").withColumn(
        "_bound", F.array_min(F.transform("places", spread))
    ).drop("node", "places")

    within = lambda children: F.transform(
        F.filter(children, lambda c: box_distance(c, here) <= F.col("_bound")),
        lambda c: c["node"],
    )
    found = found.withColumn("node", F.explode_outer(within(root)))
    for _ in range(1, tree.levels):
        # A leaf has no children and stays.
        nodes = F.when(F.col("children").isNull(), F.array("node")).otherwise(
            within(F.col("children"))
        )
        found = found.join(tree.inner, "node", "left").withColumn("_nodes", nodes)
        found = found.drop("node", "children").withColumn("node", F.explode_outer("_nodes"))
        found = found.drop("_nodes")
    return found.join(tree.leaves, "node").withColumn(
        "_best", _nearest_of("places", names)
    ).drop("node", "places", "_bound")


def assign_nearest(
    points: DataFrame,
    places: DataFrame,
    key: Sequence[str] | None = MESSAGE_KEY,
    metric: str = "haversine",
    distance: str | None = None,
    list_places: int = LIST_PLACES,
) -> DataFrame:
    """Add to every point the ``city`` of the place nearest to it.

    ``points`` and ``places`` both have ``lat`` and ``lon`` in degrees; points without finite
    coordinates are dropped, as are places without them or without a name, and with no place
    left there are no rows. Of equally near places the first by name wins. ``distance`` names
    an optional column with the distance in km. Places may be any number, anywhere.

    With a ``key``, points that share it collapse to the one nearest to any place (then the
    first by city, latitude and longitude), which costs one shuffle on the key; pass
    ``key=None`` when keys are known to be unique, which saves it with up to ``list_places``
    places. The list, or the tree of the places, is made when this is called.
    """
    kilometres = metric_function(metric)
    names = _AXES[: 2 if metric == "planar" else 3]
    at = dict(zip(names, _axes(F.col("lat"), F.col("lon"), metric)))
    located = points.where(_on_map()).withColumns(at)
    named = places.where(_on_map() & F.col("city").isNotNull()).select("city", "lat", "lon")
    # Of places at one spot only the first by name can win.
    spots = named.withColumns(at).groupBy(*names).agg(
        F.min(F.struct("city", "lat", "lon")).alias("first")
    ).select(*names, "first.*")
    tree = build_tree(spots, names, list_places, along=("lat", "lon"))
    if tree.places is not None:
        matched = _by_list(located, tree.places, names)
        together = key
    else:
        row = F.monotonically_increasing_id()
        together = key or ["_row"]
        matched = _by_tree(located if key else located.withColumn("_row", row), tree, names)
    place = F.col("_best")
    found = {"city": place["city"]}
    if distance:
        found[distance] = kilometres(F.col("lat"), F.col("lon"), place["lat"], place["lon"])
    found["_spread"] = place["spread"]
    matched = matched.withColumns(found).drop("_best", *names)
    if not together:
        return matched.drop("_spread")
    # The first of each key after one exchange and one sort; asking for what lies before it,
    # and not for a rank, keeps the rows from being sorted ahead of the exchange as well.
    in_order = Window.partitionBy(*together).orderBy("_spread", "city", "lat", "lon")
    before = F.lag(F.lit(1)).over(in_order)
    return matched.withColumn("_before", before).where(F.col("_before").isNull()).drop(
        "_before", "_spread", "_row"
    )


def message_city(events: DataFrame, cities: DataFrame, lenient: bool = True) -> DataFrame:
    """Every located message of the log with its nearest city."""
    matched = assign_nearest(normalize_messages(events, lenient), cities)
    return matched.select("message_id", "user_id", "datetime", "city", "lat", "lon", "date")
