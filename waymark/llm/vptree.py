"""Approximate nearest neighbours by vantage-point trees, one per shard of the vectors.

Largest inner product becomes least distance with one more coordinate, which gives all vectors
the length of the longest. A tree splits the vectors of its shard in two by their distance to
a vantage point, again and again. By the triangle inequality a half can be passed over if it
lies farther from the query than the nearest found so far; a factor above one passes over more
of them, a factor of one gives the exact result.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.shared import stored

NEIGHBOURS = 20
FACTOR = 1.05
SHARD_VECTORS = 16_384
QUERY_BLOCK = 4_096
LEAF_VECTORS = 128
# Results kept beyond those asked for until scores are computed in a fixed order.
SPARE = 12


def usable_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v, dim``: vectors of finite components, at least one of them not zero."""
    v = F.col(vector)
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, number) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(key).isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.col(key).cast("long").alias("id"), v.cast("array<double>").alias("v"),
        F.size(v).alias("dim"),
    )


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as found:
        return {name: found[name] for name in found.files}


def build_tree(vectors: np.ndarray, longest: float, leaf: int = LEAF_VECTORS) -> dict:
    """A vantage-point tree over rows: ``order`` lists them so that each node is a range;
    ``nodes`` has its begin, end, middle and vantage row, ``radius`` the split distance."""
    norms = (vectors**2).sum(axis=1)
    lifted = np.hstack([vectors, np.sqrt(np.maximum(0.0, longest**2 - norms))[:, None]])
    order = np.arange(len(vectors))
    nodes, radius = [], []
    todo = [(0, len(vectors))]
    rng = np.random.default_rng(len(vectors))
    while todo:
        begin, end = todo.pop()
        if end - begin <= leaf:
            continue
        rows = order[begin:end]
        vantage = int(rows[rng.integers(len(rows))])
        far = np.sqrt(((lifted[rows] - lifted[vantage]) ** 2).sum(axis=1))
        middle = len(rows) // 2
        by_distance = np.argpartition(far, middle)
        order[begin:end] = rows[by_distance]
        nodes.append((begin, end, begin + middle, vantage))
        radius.append((far[by_distance[:middle]].max(), far[by_distance[middle:]].min()))
        todo += [(begin, begin + middle), (begin + middle, end)]
    return {
        "order": order, "lifted": lifted, "nodes": np.array(nodes, np.int64).reshape(-1, 4),
        "radius": np.array(radius, float).reshape(-1, 2),
    }


def search_tree(
    tree: dict, queries: np.ndarray, k: int, factor: float, visits: np.ndarray | None = None
) -> np.ndarray:
    """The ``k`` rows nearest to each query that the search finds (−1 beyond their number).
    ``visits`` is added the number of leaves that each query was held against."""
    lifted, order = tree["lifted"], tree["order"]
    asked = np.hstack([queries, np.zeros((len(queries), 1))])
    asked_sq, lifted_sq = (asked**2).sum(axis=1), (lifted**2).sum(axis=1)
    found = np.full((len(queries), k), -1)
    reach = np.full((len(queries), k), np.inf)
    node_at = {(int(b), int(e)): n for n, (b, e, _, _) in enumerate(tree["nodes"])}

    def distances(who: np.ndarray, rows: np.ndarray) -> np.ndarray:
        squared = asked_sq[who, None] - 2 * asked[who] @ lifted[rows].T + lifted_sq[rows]
        return np.sqrt(np.maximum(squared, 0.0))

    def visit(begin: int, end: int, who: np.ndarray) -> None:
        if not len(who):
            return
        number = node_at.get((begin, end))
        if number is None:
            rows = order[begin:end]
            if visits is not None:
                visits[who] += 1
            all_reach = np.hstack([reach[who], distances(who, rows)])
            all_found = np.hstack([found[who], np.broadcast_to(rows, (len(who), len(rows)))])
            best = np.argpartition(all_reach, k - 1, axis=1)[:, :k]
            reach[who] = np.take_along_axis(all_reach, best, axis=1)
            found[who] = np.take_along_axis(all_found, best, axis=1)
            return
        middle, vantage = int(tree["nodes"][number, 2]), int(tree["nodes"][number, 3])
        inner, outer = tree["radius"][number]
        away = distances(who, np.array([vantage]))[:, 0]
        inside = away <= (inner + outer) / 2
        visit(begin, middle, who[inside])
        visit(middle, end, who[~inside])
        # The other half, where it may still hold something nearer than the worst found.
        worst = reach[who].max(axis=1) / factor
        visit(middle, end, who[inside & (outer - away <= worst)])
        visit(begin, middle, who[~inside & (away - inner <= worst)])

    if len(order):
        visit(0, len(order), np.arange(len(queries)))
    return found


def build_index(
    vectors: DataFrame, key: str, vector: str, copies: int, shard_vectors: int = SHARD_VECTORS,
    leaf: int = LEAF_VECTORS,
) -> DataFrame:
    """``dim, shard, tree``: every usable vector in the tree of a shard of bounded size.

    Vectors of different length are never compared and have shards of their own. Equal vectors
    of a shard are one entry with their ``copies`` smallest ids, as no query returns more.
    """
    usable = usable_vectors(vectors, key, vector)
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    sizes = usable.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.max(squares)).alias("longest")
    ).withColumn("shards", F.ceil(F.col("n") / shard_vectors).cast("int"))
    # A row per vector length; Spark sees how few they are.
    dealt = usable.join(sizes, "dim").withColumn(
        "shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int")
    )

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        matrix = np.array(rows["v"].tolist(), float)
        distinct, group = np.unique(matrix, axis=0, return_inverse=True)
        group = group.reshape(-1)
        ids = np.zeros((len(distinct), copies), np.int64)
        order = np.argsort(group, kind="stable")
        nth = np.arange(len(order)) - np.searchsorted(group[order], group[order])
        keep = nth < copies
        ids[group[order][keep], nth[keep]] = rows["id"].to_numpy()[order][keep]
        tree = build_tree(distinct, float(rows["longest"].iloc[0]), leaf)
        held = np.bincount(group[order][keep], minlength=len(distinct))
        data = _packed(ids=ids, held=held, vectors=distinct, **tree)
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "tree": [data]})

    return dealt.select("dim", "shard", "id", "v", "longest").groupBy("dim", "shard").applyInPandas(
        build, "dim int, shard int, tree binary"
    )


def nearest_vectors(
    vectors: DataFrame,
    every: int = 20,
    k: int = NEIGHBOURS,
    factor: float = FACTOR,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_vectors: int = SHARD_VECTORS,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` vectors of largest inner product with each
    query, nearest first, ties to the smaller id; fewer if there are not as many.

    Queries are the vectors whose id is divisible by ``every``; all others are candidates, and
    queries for each other. Vectors that are null, empty, zero or hold a null or non-finite
    component, and rows of null id, take no part. Rows that repeat in id are one vector if
    equal. Other columns are ignored. Queries meet the shards in blocks.
    """
    columns = vectors.select(key, vector).distinct()
    index = stored(build_index(columns, key, vector, k + 1, shard_vectors), "index")
    asked = usable_vectors(columns, key, vector).where(F.col("id") % every == 0)
    counts = asked.groupBy("dim").agg(
        F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("blocks")
    )
    asked = asked.join(counts, "dim").withColumn(
        "block", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int")
    )

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        data = _packed(ids=rows["id"].to_numpy(), vectors=np.array(rows["v"].tolist(), float))
        return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "queries": [data]})

    blocks = stored(
        asked.select("dim", "block", "id", "v").groupBy("dim", "block").applyInPandas(
            pack, "dim int, block int, queries binary"
        ),
        "queries",
    )
    # The stated query set against all rows: each pair of a block and a shard is one task.
    trees = index.join(blocks.select("dim", "block"), "dim").toDF("dim", "shard", "tree", "block")
    waiting = blocks.join(index.select("dim", "shard"), "dim")
    waiting = waiting.toDF("dim", "block", "queries", "shard")

    def search(key: tuple, own: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if own.empty or theirs.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        tree, ask = _unpacked(own["tree"].iloc[0]), _unpacked(theirs["queries"].iloc[0])
        rows = search_tree(tree, ask["vectors"], min(k + 1 + SPARE, len(tree["order"])), factor)
        who, at = np.nonzero(rows >= 0)
        rows = rows[who, at]
        # The same sum in the same order for every pair, so that equal vectors tie exactly.
        score = (ask["vectors"][who] * tree["vectors"][rows]).sum(axis=1)
        ids = tree["ids"][rows]
        # Any number is an id, so how many a vector has is kept beside them.
        pair, copy = np.nonzero(np.arange(ids.shape[1]) < tree["held"][rows][:, None])
        out = pd.DataFrame({
            "query_id": ask["ids"][who[pair]], "vec_id": ids[pair, copy], "score": score[pair],
        })
        out = out[out["query_id"] != out["vec_id"]]
        out = out.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return out.groupby("query_id").head(k)

    found = (
        trees.groupBy("dim", "shard", "block")
        .cogroup(waiting.groupBy("dim", "shard", "block"))
        .applyInPandas(search, "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
