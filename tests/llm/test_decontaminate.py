import plain
import pytest

from waymark.llm import decontaminate
from waymark.llm.decontaminate import contamination, is_contaminated

ITEMS = "item_id long, text string, words string"


def expected(doc, items, window=13):
    own, hit, ids = plain.words(doc), set(), set()
    for item_id, text in items:
        there = plain.words(text)
        if item_id is None or not there:
            continue
        size = min(window, len(there))
        for s in range(len(there) - size + 1):
            for at in range(len(own) - size + 1):
                if own[at : at + size] == there[s : s + size]:
                    hit |= set(range(at, at + size))
                    ids.add(str(item_id))
    return len(own), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(own)


@pytest.mark.parametrize("broadcast_rows", [0, 10_000])
@pytest.mark.parametrize("rows", [plain.ODD, "long"])
def test_equals_brute_force(spark, rows, broadcast_rows):
    long = " ".join(f"w{n % 50}" for n in range(30_000))
    passage = " ".join(f"p{n}" for n in range(40))
    if rows == "long":
        rows = [
            (1, long, "en", "a", 1), (2, f"Before {passage.upper()} after " * 3, "en", "a", 1),
            (3, passage[: len(passage) // 2], "en", "a", 1),
            (4, f"{long} {passage}", "en", "a", 1), (5, "a a a a a a a a", None, None, None),
        ]
    items = [
        (1, passage), (1, "one ID"), (2, "a"), (3, "a a a"), (4, None), (None, passage),
        (5, "!!"), (6, passage), (7, "same row twice over AND over"), (-8, "w1 w2 w3 w4"),
        (9, " ".join(f"w{n % 50}" for n in range(14))),
    ]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    found = contamination(plain.documents(spark, rows), benchmark, broadcast_rows=broadcast_rows)
    found = found.select("doc_id", "n_words", "n_hit", "item_ids", is_contaminated().alias("bad"))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(
        str((r[0], *expected(r[1], items))) for r in rows
    )


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "one id", "x")], ITEMS)
    assert contamination(plain.empty(spark), some).count() == 0
    for benchmark in (none, spark.createDataFrame([(1, None, "x")], ITEMS)):
        found = contamination(plain.documents(spark), benchmark)
        assert found.count() == len(plain.ODD)
        assert found.where("n_hit > 0 OR size(item_ids) > 0").count() == 0


def test_only_the_rarest_shingle_is_looked_for(spark):
    docs = spark.createDataFrame(
        [(n, "the of and the of and " * 5) for n in range(50)] + [(99, "x the of and y z")],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(1, "the of and y z")], "item_id long, text string")
    matches = decontaminate.window_matches(docs, items)
    assert [(r.start, r.length) for r in matches.collect()] == [(1, 5)]
    plan = matches._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan
