import math
import random

import numpy as np
import plain
import pyarrow.parquet as pq
import pytest

from waymark.llm.registry import op9_nearest_vectors
from waymark.llm.vptree import build_tree, nearest_vectors, search_tree

VECTORS = "vec_id long, embedding array<float>, label string, score string, rank string"


def expected(rows, k):
    sound = sorted({
        (i, tuple(v)) for i, v, *_ in rows
        if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)
    })
    found = []
    for i, v in sound:
        if i % 20:
            continue
        others = [(-sum(a * b for a, b in zip(v, w)), j) for j, w in sound
                  if j != i and len(w) == len(v)]
        found += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(others)[:k])]
    return sorted(found)


@pytest.mark.parametrize("shard_vectors", [64, 100_000])
def test_factor_one_is_exact(spark, shard_vectors):
    dice = random.Random(3)
    # Whole numbers, so that ties are exact; many equal vectors, of different lengths.
    rows = [(n, [float(dice.randrange(-3, 4)) for _ in range(5)]) for n in range(400)]
    rows += [(n + 1000, [1.0, 2.0, 0.0, 0.0, 1.0]) for n in range(60)]
    rows += [(n - 40, [1.0, 1.0]) for n in range(30)]
    rows += [(-(2**63), [3.0, 3.0, 3.0, -3.0, 3.0])]
    rows += [(5000, None), (5020, []), (5040, [0.0] * 5), (5060, [1.0, None, 0.0, 0.0, 0.0]),
             (5080, [float("nan")] * 5), (5100, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
             (None, [1.0] * 5), (40, rows[40][1])]
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], VECTORS)
    found = nearest_vectors(df, factor=1.0, shard_vectors=shard_vectors, query_block=7)
    assert sorted(tuple(r) for r in found.collect()) == expected(rows, 20)


def test_recall_of_the_registered_query(spark):
    found = op9_nearest_vectors(spark, "/root/testdata/sf0.01").collect()
    rows = [(r.vec_id, list(r.embedding))
            for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    want = expected(rows, 20)
    near = {(q, v) for q, _, v, _ in want}
    assert len(found) == len(want)
    assert len(near & {(r.query_id, r.vec_id) for r in found}) >= 0.9 * len(want)


def test_a_larger_factor_searches_less_and_one_is_exact():
    dice = np.random.default_rng(5)
    vectors = dice.normal(size=(3000, 4))
    tree = build_tree(vectors, float(np.sqrt((vectors**2).sum(axis=1)).max()), leaf=16)
    ask = vectors[:50]
    exact = np.argsort(-(ask @ vectors.T), axis=1, kind="stable")[:, :10]
    recall = lambda factor: np.mean([
        len(set(a) & set(b)) / 10 for a, b in zip(exact, search_tree(tree, ask, 10, factor))
    ])
    assert recall(1.0) == 1.0 and recall(1.0) >= recall(3.0) > 0.3


def test_few_or_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], "x", "x", "x"), (1, [0.5, 0.5], "x", "x", "x")], VECTORS)
    assert [tuple(r) for r in nearest_vectors(few).collect()] == [(0, 1, 1, 0.5)]
    assert nearest_vectors(few.where("vec_id = 0")).count() == 0
    assert nearest_vectors(few.where("vec_id > 5")).count() == 0


def leaves_visited(vectors, asked, factor):
    """Part of the leaves that a query is held against, and of the nearest 20 that it finds."""
    tree = build_tree(vectors, float(np.sqrt((vectors**2).sum(axis=1).max())), leaf=64)
    visits = np.zeros(len(asked))
    found = search_tree(tree, asked, 20, factor, visits)
    exact = np.argsort(-(asked @ vectors.T), axis=1, kind="stable")[:, :20]
    hits = np.mean([len(set(f) & set(e)) / 20 for f, e in zip(found.tolist(), exact.tolist())])
    # Leaves halve a node until they hold 64 at most.
    return visits.mean() / (len(tree["nodes"]) + 1), hits


def test_leaves_are_passed_over_where_vectors_lie_in_groups():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(60, 24))
    vectors = centres[rng.integers(0, 60, 6_000)] + 0.05 * rng.normal(size=(6_000, 24))
    vectors /= np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    part, recall = leaves_visited(vectors, vectors[:200], 1.0)
    assert recall == 1.0 and part < 0.25
    less, recall = leaves_visited(vectors, vectors[:200], 1.5)
    assert less <= part and recall >= 0.9


def test_leaves_of_vectors_spread_evenly_are_all_visited():
    """In many dimensions all distances are much alike, and no triangle tells them apart: the
    registered table is of this kind, so its exactness is not owed to a lucky pruning."""
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    vectors = np.stack(table["embedding"].to_numpy()).astype(float)
    for factor in (1.0, 1.05, 1.5):
        part, recall = leaves_visited(vectors, vectors[::20], factor)
        assert recall == 1.0 and part > 0.99
