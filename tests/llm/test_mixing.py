from collections import Counter, defaultdict

import numpy as np
import plain
import pytest

from pyspark.sql import functions as F

from waymark.llm import mixing
from waymark.llm.mixing import (
    draw_counts,
    mix_sources,
    mixed_documents,
    mixing_targets,
    permuted,
    source_draws,
    source_targets,
)


@pytest.mark.parametrize("sizes, weights", [
    ([100, 100, 100], [3, 1, 2]), ([1000, 10, 10], [1, 3, 3]), ([0, 50, 0], [3, 1, 2]),
    ([5], [1]), ([], []), ([0, 0], [3, 1]),
])
def test_targets(sizes, weights):
    found = mixing_targets(sizes, weights, 1.5, 2.0)
    assert sum(found) == pytest.approx(1.5 * sum(sizes))
    assert all(t <= 2 * s + 1e-9 for t, s in zip(found, sizes))
    free = {t / w for t, s, w in zip(found, sizes, weights) if t < 2 * s - 1e-9}
    assert len({round(f, 9) for f in free}) <= 1


@pytest.mark.parametrize("count", [1, 2, 3, 7, 64, 1000])
def test_permutation_takes_every_place_once(count):
    index = np.arange(count)
    one = permuted(index, np.full(count, count), np.full(count, 5))
    assert sorted(one) == list(range(count))
    if count > 60:
        assert (one != index).any()
        assert (one != permuted(index, np.full(count, count), np.full(count, 6))).any()


def test_draws_deal_out_everything():
    totals = np.array([1000, 0, 37, 5])
    counts = draw_counts(totals, 16, 1)
    assert (counts.sum(axis=0) == totals).all() and (counts >= 0).all()
    assert counts.sum(axis=1).max() - counts.sum(axis=1).min() <= 1
    assert (counts == draw_counts(totals, 16, 1)).all()


def test_mix_comes_near_its_targets(spark):
    docs = plain.corpus(spark)
    mix = mix_sources(docs, block_words=16)
    rows = mix.taken().collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    taken, target = defaultdict(int), {}
    for r in rows:
        assert r.size == len(text[r.doc_id].encode().split()) and r.taken <= 2 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] + 16 for s in target)
    key = ("doc_id", "size", "source_size", "target", "taken")
    again = mix_sources(docs.repartition(7), block_words=16).taken()
    assert plain.as_text(again, *key) == plain.as_text(mix.taken(), *key)


def test_slots_hold_whole_blocks(spark):
    docs = spark.createDataFrame(
        [(n, "w " * (n * 7 % 23), "en", "ab"[n % 2], 0) for n in range(40)], plain.DOCUMENTS
    )
    pieces = mix_sources(docs, block_words=10, shards=4).pieces.collect()
    slots = Counter()
    for p in pieces:
        slots[p.shard, p["rank"], p.slot] += p.n_words
    size = {s: sum(n * 7 % 23 for n in range(40) if "ab"[n % 2] == s) for s in "ab"}
    assert all(words <= 10 for words in slots.values())
    short = [words for words in slots.values() if words < 10]
    assert set(short) <= {size[s] % 10 for s in "ab"}


def test_odd_rows(spark):
    rows = mix_sources(plain.documents(spark), block_words=1).taken().collect()
    size = lambda d: len((d[1] or "").encode().split())
    assert sorted((str(r.doc_id), str(r.source), r.size) for r in rows) == sorted(
        (str(d[0]), str(d[3]), size(d)) for d in plain.ODD
    )
    assert all(r.taken <= 2 * r.size for r in rows)
    assert sum(r.taken for r in rows) == pytest.approx(1.5 * sum(map(size, plain.ODD)), abs=2)
    assert mix_sources(plain.empty(spark)).taken().count() == 0


def test_mixed_documents_hold_the_words_taken(spark):
    docs = plain.documents(spark)
    mixed = mixed_documents(docs, block_words=2, shards=3)
    assert mixed.columns == docs.columns and mixed.schema["n_chars"].dataType.typeName() == "long"
    taken = Counter()
    for r in mix_sources(docs, block_words=2, shards=3).taken().collect():
        taken[str(r.doc_id), str(r.source)] += r.taken
    out = Counter()
    given = {(str(d[0]), str(d[3]), w) for d in plain.ODD for w in (d[1] or "").split()}
    for r in mixed.collect():
        out[str(r.doc_id), str(r.source)] += len(r.text.split())
        assert all((str(r.doc_id), str(r.source), w) in given for w in r.text.split())
        assert r.n_chars == len(r.text) and r.k1 == "x"
    assert out == Counter({k: n for k, n in taken.items() if n})
    assert mixed_documents(plain.empty(spark)).count() == 0


def test_any_number_of_sources(spark, monkeypatch):
    """100,000 sources of one document each, and one that holds a third of all words."""
    docs = spark.range(100_000).select(
        F.col("id").alias("doc_id"), F.lit("a few words here").alias("text"),
        F.concat(F.lit("host "), "id").alias("source"),
    ).unionByName(spark.range(1_000).select(
        (F.col("id") + 200_000).alias("doc_id"), F.repeat(F.lit("word "), 200).alias("text"),
        F.lit("large").alias("source"),
    ))
    mix = mix_sources(docs, block_words=4)
    sums = mix.taken().groupBy((F.col("source") == "large").alias("large")).agg(
        F.sum("taken").alias("taken"), F.sum("size").alias("size"),
        F.max(F.col("taken") - 2 * F.col("size")).alias("over"), F.count("*").alias("n"),
    ).collect()
    assert {r.large: r.n for r in sums} == {True: 1_000, False: 100_000}
    assert all(r.over <= 0 for r in sums)
    # Blocks are whole, so what rounding adds to a small source's target may show in the sum.
    assert abs(sum(r.taken for r in sums) / sum(r.size for r in sums) - 1.5) < 0.15
    target = mix.documents.select("source", "target").distinct().agg(F.sum("target")).first()[0]
    assert target == pytest.approx(1.5 * sum(r.size for r in sums))


@pytest.mark.parametrize("sizes", [
    [100, 100, 100], [1000, 10, 10, 7, 3000], [0, 50, 0], [5], [], [0, 0], [1, 10, 100, 1000] * 5,
])
def test_targets_in_rounds_equal_those_on_the_driver(spark, sizes):
    rows = [(f"s{n:03}", s) for n, s in enumerate(sizes)][::-1]
    if len(rows) > 3:
        rows[0] = (None, rows[0][1])
    frame = spark.createDataFrame(rows, "source string, size long")
    found = source_targets(frame, [3, 1, 2], 1.5, 2.0).orderBy("rank").collect()
    assert [r["rank"] for r in found] == list(range(len(sizes)))
    assert [r.source_size for r in found] == sizes
    weights = [[3, 1, 2][n % 3] for n in range(len(sizes))]
    assert [r.target for r in found] == pytest.approx(mixing_targets(sizes, weights, 1.5, 2.0))


def test_draws_of_groups_give_each_shard_its_even_part(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_SOURCES", 3)
    totals = [100, 0, 37, 5, 900, 1, 1, 64, 64, 64]
    frame = spark.createDataFrame(
        [(n, 2 * t, t) for n, t in enumerate(totals)], "rank long, blocks long, total long"
    )
    drawn, total = source_draws(frame, 7, 1)
    rows = drawn.collect()
    assert total == sum(totals)
    per_shard, per_rank = Counter(), defaultdict(list)
    for r in rows:
        per_shard[r.shard] += r["count"]
        per_rank[r["rank"]].append((r.begin, r["count"]))
    assert max(per_shard.values()) - min(per_shard.values()) <= 1
    for rank, runs in per_rank.items():
        at = 0
        for begin, count in sorted(runs):
            assert begin == at
            at += count
        assert at == totals[rank]
