import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import plain
import pytest
from tokenizers import Tokenizer

from waymark.llm.packing import Sums, pack_documents, plan_sequences, sequences
from waymark.llm.registry import TOKENIZER, op12_packing


def encoded(texts):
    own = Tokenizer.from_file(TOKENIZER)
    return [[*own.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def check(found, rows, capacity):
    """Pieces are those of the definition and fill sequences without gaps or overlaps."""
    wanted = []
    for doc_id, ids in rows:
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for n, a in enumerate(starts):
            data = ids[a : [*starts, len(ids)][n + 1]]
            wanted.append(str((doc_id, n, a, len(data),
                               zlib.crc32(np.array(data, "<u4").tobytes()))))
    got = [str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in found]
    assert sorted(got) == sorted(wanted)
    held = defaultdict(list)
    for r in found:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("capacity", [4, 64, 2048])
def test_pieces_and_places(spark, capacity):
    docs = plain.corpus(spark).repartition(5)
    given = [(r.doc_id, r.text) for r in docs.collect()]
    ids = encoded([t for _, t in given])
    found = pack_documents(docs, TOKENIZER, capacity).collect()
    n = check(found, [(d, i) for (d, _), i in zip(given, ids)], capacity)
    least = -(-sum(map(len, ids)) // capacity)
    assert least <= n <= least * 1.05 + 1


def test_odd_rows_and_empty_table(spark):
    docs = plain.documents(spark)
    given = [(r.doc_id, r.text) for r in docs.collect()]
    ids = encoded([t for _, t in given])
    found = pack_documents(docs, TOKENIZER, 8).collect()
    check(found, [(d, i) for (d, _), i in zip(given, ids)], 8)
    assert pack_documents(plain.empty(spark), TOKENIZER).collect() == []


def test_sequences_hold_the_ids(spark):
    docs = plain.documents(spark, [(n, f"text {n} " * n, None, None, None) for n in range(30)])
    packed = pack_documents(docs, TOKENIZER, 32, keep_ids=True)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in sequences(packed).collect()}
    ids = dict(zip(range(30), encoded([f"text {n} " * n for n in range(30)])))
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == (
            ids[r.doc_id][r.start : r.start + r.length])
    assert max(map(len, whole.values())) <= 32


def test_registered_table(spark):
    sf = "/root/testdata/sf0.001"
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    ids = encoded([t for _, t in given])
    found = op12_packing(spark, sf)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                             "offset"]
    n = check(found.collect(), [(d, i) for (d, _), i in zip(given, ids)], 2048)
    assert n <= -(-sum(map(len, ids)) // 2048) + 1


@pytest.mark.parametrize("seed", range(12))
def test_plan_uses_up_the_lengths(seed):
    dice = random.Random(seed)
    capacity = dice.choice([5, 30, 100])
    counts = {n: dice.choice([1, 2, 50, 1000]) for n in range(1, capacity + 1)
              if dice.random() < 0.3}
    runs = plan_sequences(counts, capacity)
    used = Counter()
    for times, lengths in runs:
        assert times > 0 and sum(lengths) <= capacity
        for length in lengths:
            used[length] += times
    assert used == counts
    least = -(-sum(n * c for n, c in counts.items()) // capacity)
    # Pieces over half of the capacity need a sequence each.
    least = max(least, sum(c for n, c in counts.items() if 2 * n > capacity))
    assert sum(t for t, _ in runs) <= 1.25 * least + 1
    assert len(runs) <= 8 * capacity


def test_complements_equal_trying_all():
    dice = random.Random(4)
    top = 24
    sums = Sums(top)
    counts = Counter()
    for _ in range(300):
        length = dice.randrange(1, top + 1)
        by = dice.choice([1, 2, -1, -2])
        by = max(by, -counts[length])
        sums.change(length, by)
        counts[length] += by
        have = sorted(counts.elements())
        gap = dice.randrange(1, top)
        fewest = next((k for k in (1, 2, 3) if any(
            sum(c) == gap for c in _choices(have, k))), None)
        found = sums.complement(gap)
        assert (len(found) if found else None) == fewest
        if found:
            assert sum(found) == gap and not Counter(found) - counts


def _choices(have, k):
    import itertools

    short = [n for n, c in Counter(have).items() for _ in range(min(c, k))]
    return itertools.combinations(short, k)


def test_exact_complements_are_found():
    # One, two and three lengths fill the gap; none is left over.
    runs = plan_sequences({60: 10, 40: 3, 25: 4, 15: 4, 20: 3, 10: 3, 5: 6}, 100)
    assert all(sum(lengths) == 100 for _, lengths in runs if 60 in lengths)
