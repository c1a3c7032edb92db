import random

import numpy as np
import plain
import pytest

from waymark.llm.components import components
from waymark.llm.simhash import (
    PIVOTS,
    distance_table,
    fingerprint,
    linked_fingerprints,
    near_duplicates,
    one_of_each,
    part_masks,
    passed,
    pivot_distances,
    pivot_fingerprints,
)


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("text", [
    None, "", "one", "Two Words", "a b c", "É É é A a", "x\ty\nz \x0b w\x0cv\x1cu",
    "the quick brown fox " * 300, " ".join(map(str, range(700))),
])
def test_fingerprint(text):
    assert fingerprint(text) == plain.fingerprint(text)


def test_parts_cover_all_bits_once():
    for parts in (4, 5, 6, 7):
        masks = part_masks(parts)
        assert sum(masks) == (1 << 64) - 1 and len(masks) == parts


def some_fingerprints(kind):
    dice = random.Random(kind)
    base = [dice.getrandbits(64) for _ in range(40)]
    if kind == "clusters":
        found = set(base)
        for b in base[:12]:
            for _ in range(12):
                near = b
                for _ in range(dice.randrange(1, 8)):
                    near ^= 1 << dice.randrange(64)
                found.add(near)
        return sorted(found)
    # All in one small ball, where every choice of parts is shared by many.
    return sorted({base[0] ^ sum(1 << b for b in dice.sample(range(12), dice.randrange(7)))
                   for _ in range(300)})


@pytest.mark.parametrize("kind", ["clusters", "ball"])
@pytest.mark.parametrize("cell_rows", [16, 2048])
def test_links_connect_what_all_pairs_would(spark, kind, cell_rows):
    marks = some_fingerprints(kind)
    near = lambda i, j: (marks[i] ^ marks[j]).bit_count() <= 3
    expected = plain.groups(len(marks), near)
    df = spark.createDataFrame([(signed(m),) for m in marks], "fp long")
    links = linked_fingerprints(df, cell_rows=cell_rows)
    at = {signed(m): n for n, m in enumerate(marks)}
    pairs = [(at[r.a], at[r.b]) for r in links.collect()]
    assert all(near(a, b) for a, b in pairs)
    linked = set(pairs)
    assert plain.groups(
        len(marks), lambda i, j: (i, j) in linked or (j, i) in linked
    ) == expected
    assert 1 < len(set(expected)) or kind == "ball"
    found = {r.node: r.root for r in components(links).collect()}
    for i, m in enumerate(marks):
        own = [signed(marks[j]) for j in range(len(marks)) if expected[j] == expected[i]]
        assert found.get(signed(m), signed(m)) == min(own)


def test_components_of_chains_and_none(spark):
    chain = [(n, n + 1) for n in range(60)] + [(100, 90), (90, 95), (7, 7)]
    edges = spark.createDataFrame(chain, "a long, b long").repartition(5)
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {**{n: 0 for n in range(61)}, 90: 90, 95: 90, 100: 90}
    assert components(edges.where("a > 1000")).count() == 0


def expected_components(rows):
    marks = [plain.fingerprint(r[1]) for r in rows]
    own = plain.groups(len(rows), lambda i, j: (marks[i] ^ marks[j]).bit_count() <= 3)
    least = {}
    for r, g in zip(rows, own):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    return marks, own, [least.get(g) for g in own]


@pytest.mark.parametrize("given", ["corpus", "odd"])
def test_near_duplicates_equal_brute_force(spark, given):
    docs = plain.corpus(spark) if given == "corpus" else plain.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    marks, own, least = expected_components(rows)
    found = near_duplicates(docs).select("doc_id", "fp", "component_id")
    assert plain.as_text(found) == sorted(
        str((d, signed(m), c)) for (d, _), m, c in zip(rows, marks, least)
    )
    assert len(set(own)) < len(rows)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(own))
    ids = {r.doc_id for r in kept.collect()}
    assert ids == set(least)
    assert set(plain.as_text(docs)) >= set(plain.as_text(kept))


def test_empty_table(spark):
    assert near_duplicates(plain.empty(spark)).count() == 0
    assert one_of_each(plain.empty(spark)).count() == 0


def test_distance_table_bounds_distances():
    marks = np.array(some_fingerprints("clusters"), np.uint64)
    table = pivot_distances(marks, pivot_fingerprints(5)).astype(int)
    apart = np.bitwise_count(marks[:, None] ^ marks[None, :])
    assert (np.abs(table[:, None] - table[None]).max(axis=2) <= apart).all()


def test_the_table_is_stored_and_discards_nearly_all_unrelated_pairs(spark):
    dice = random.Random(7)
    marks = [dice.getrandbits(64) for _ in range(600)]
    rows = distance_table(spark.createDataFrame([(signed(m),) for m in marks], "fp long"), PIVOTS)
    found = {r.fp: (r.d0, r.table) for r in rows.collect()}
    references = pivot_fingerprints(PIVOTS).tolist()
    for m in marks:
        own = [(m ^ r).bit_count() for r in references]
        assert found[signed(m)] == (own[0], bytes(own))
    table = pivot_distances(np.array(marks, np.uint64), pivot_fingerprints(PIVOTS))
    a, b = np.triu_indices(len(marks), 1)
    # Thirty-two references leave hardly a pair to verify, eight still a few in a hundred.
    assert len(passed(table, a, b, 3)) < 1e-4 * len(a)
    assert len(passed(table[:, :8], a, b, 3)) < 0.05 * len(a)
    near = np.array([marks[0], marks[0] ^ 0b10101], np.uint64)
    table = pivot_distances(near, pivot_fingerprints(PIVOTS))
    assert len(passed(table, np.array([0]), np.array([1]), 3)) == 1
