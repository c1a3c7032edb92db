import math
import random

import numpy as np
import pytest

from waymark.llm.registry import op11_whitening
from waymark.llm.whitening import whiten

VECTORS = "vec_id long, embedding array<float>, component string, n string, x string, part string"


def plain(rows, components=16):
    """Number, deviations, eigenvalues and eigenvectors of the definition."""
    sound = [(i, v) for i, v in rows if v and None not in v and all(map(math.isfinite, v))]
    grid = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in sound]
    fit = sorted({tuple(x) for _, x in grid})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(x, sums)) for _, x in grid]
    centred = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = values.argsort()[::-1][:components]
    here = np.array([[n * c - s for c, s in zip(x, sums)] for _, x in grid], float) / n
    return n, grid, deviation, values[order], vectors[:, order], here, values.sum()


def check(found, rows, components=16):
    n, grid, deviation, values, vectors, here, trace = plain(rows, components)
    assert len(found) == len(grid) * len(values)
    whitened = here @ vectors / np.sqrt(values)
    by_row = {}
    for r in found:
        by_row.setdefault(r.component, []).append((r.vec_id, r.deviation, r.whitened))
        assert r.n == n
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9)
        assert 0 <= r.identity_error < 1e-6
    for c in range(len(values)):
        wanted = [(i, d, w) for (i, _), d, w in zip(grid, deviation, whitened[:, c])]
        sums = [sum(a[2] * b[2] for a, b in zip(sorted(by_row[c + 1]), sorted(wanted)))]
        sign = math.copysign(1, sums[0])
        wanted = sorted((i, d, round(sign * w, 6) + 0.0) for i, d, w in wanted)
        have = sorted((i, d, round(w, 6) + 0.0) for i, d, w in by_row[c + 1])
        assert [(i, d) for i, d, _ in have] == [(i, d) for i, d, _ in wanted]
        assert [w for *_, w in have] == pytest.approx([w for *_, w in wanted], abs=1e-5)


def some(count, dim, seed=1):
    dice = random.Random(seed)
    return [
        (n, [np.float32(dice.gauss(0, 1 + k)).item() for k in range(dim)]) for n in range(count)
    ]


@pytest.mark.parametrize("panel_rows", [2**29, 40])
def test_equals_plain_version(spark, panel_rows):
    rows = some(300, 5)
    rows += [(n + 1000, rows[0][1]) for n in range(80)]  # copies weigh nothing in the fit
    rows += [(7, [1.0, 2.0, 3.0, 4.0, 5.0]), (7, [1.0, 2.0, 3.0, 4.0, 5.0])]
    odd = [(2000, None), (2001, []), (2002, [1.0, None, 1.0, 1.0, 1.0]),
           (2003, [float("nan")] * 5), (2004, [float("inf")] * 5), (2005, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in rows + odd], VECTORS)
    found = whiten(df.repartition(6), panel_rows=panel_rows)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                             "identity_error"]
    check(found.collect(), rows)


def test_registered_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    check(op11_whitening(spark, "/root/testdata/sf0.001").collect(), rows)


def test_no_spread_and_empty(spark):
    frame = lambda rows: spark.createDataFrame([(*r, "", "", "", "") for r in rows], VECTORS)
    assert whiten(frame([])).collect() == []
    assert whiten(frame([(1, None), (2, [])])).collect() == []
    alone = whiten(frame([(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert sorted(str(r.vec_id) for r in alone) == ["1", "1", "None", "None"]
    assert all((r.n, r.deviation, r.whitened, r.explained, r.identity_error)
               == (1, 0, None, None, None) for r in alone)
    # One of two dimensions has no spread.
    flat = whiten(frame([(n, [float(n), 3.0]) for n in range(9)])).collect()
    assert len(flat) == 18
    assert all((r.whitened is None) == (r.component == 2) for r in flat)
    assert all(r.identity_error < 1e-9 for r in flat)


def test_entries_far_out(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [5.0, 1.0])]
    found = whiten(spark.createDataFrame([(*r, "", "", "", "") for r in rows], VECTORS)).collect()
    # The two far ones cancel out, so the third is still exact.
    far = {r.vec_id: r.deviation for r in found}
    assert len(found) == 6 and far == {1: None, 2: None, 3: (15 * 64 - 5 * 64) ** 2
                                       + (3 * 64 - 64) ** 2}
