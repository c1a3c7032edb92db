"""Which users of two blocks have points near each other: what one task of the distance join does.

Points of a user that lie in one part of a cell are one box. Boxes of neighbouring cells meet;
their least and greatest distance settle most pairs, and points settle the rest. Pairs found
are marks in a table of the users of one block by those of the other, so a pair that meets in
many places costs no more memory than one that meets in one.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from waymark.functions.distance import EARTH_RADIUS_KM, KM_PER_DEGREE
from waymark.functions.grid import MARGIN

# Parts of a cell along each axis.
PARTS = 8
# Meetings looked at together, and pairs given out together.
_BATCH = 1 << 20
# Cells along an axis at most; they are larger than the distance where there would be more.
_MOST_CELLS = 1 << 20


class _Metric:
    """Coordinates in which straight lines order pairs of points like the metric does."""

    def __init__(self, km: float, metric: str):
        self.km, self.planar = km, metric == "planar"
        if self.planar:
            self.reach = km / KM_PER_DEGREE
        else:
            chord = 2 * math.sin(min(km / (2 * EARTH_RADIUS_KM), math.pi / 2))
            # Wider than what rounding does to the chord or to the great-circle formula.
            margin = 1e-9 * chord + 1e-14
            self.reach = chord + margin
            self.sure = max(chord - margin, 0.0) ** 2 if chord > margin else -1.0

    def axes(self, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
        if self.planar:
            return np.stack([lat, lon])
        lat, lon = np.radians(lat), np.radians(lon)
        return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)])

    def judged(self, least: list[np.ndarray], greatest: list[np.ndarray]):
        """Whether two boxes can hold near points, and whether any two of theirs surely are."""
        total = lambda steps: sum(s * s for s in steps[1:]) + steps[0] * steps[0]
        if self.planar:
            # The steps of the planar distance, so that the last bit is the same.
            length = lambda steps: np.sqrt(total(steps)) * KM_PER_DEGREE
            return length(least) <= self.km, length(greatest) <= self.km
        return total(least) <= self.reach ** 2, total(greatest) <= self.sure


class _Side:
    """The points of the users of a block, ordered by user and part, and their boxes."""

    def __init__(self, rows: pa.Table, metric: _Metric):
        self.users = rows.column("user_id").combine_chunks()
        self.shared = rows.column("shared").combine_chunks()
        listed = rows.column("lat").combine_chunks()
        counts = np.diff(listed.offsets.to_numpy())
        user = np.repeat(np.arange(len(counts)), counts)
        lat = listed.flatten().to_numpy(zero_copy_only=False)
        lon = rows.column("lon").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        there = np.isfinite(lat) & np.isfinite(lon)
        self.user, self.lat, self.lon = user[there], lat[there], lon[there]
        self.at = metric.axes(self.lat, self.lon)

    def boxed(self, origin: np.ndarray, cell: float, span: int) -> None:
        part = np.floor((self.at - origin[:, None]) * (PARTS / cell)).astype(np.int64)
        order = np.lexsort((*part, self.user))
        self.user, self.lat, self.lon = self.user[order], self.lat[order], self.lon[order]
        self.at, part = self.at[:, order], part[:, order]
        keys = np.vstack([self.user, part])
        first = np.ones(len(order), bool)
        first[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        self.start = np.flatnonzero(first)
        self.count = np.diff(np.append(self.start, len(order)))
        self.lo = np.minimum.reduceat(self.at, self.start, axis=1)
        self.hi = np.maximum.reduceat(self.at, self.start, axis=1)
        self.single = (self.lo == self.hi).all(axis=0)
        self.box_user = self.user[self.start]
        self.cell = part[:, self.start] // PARTS + 1
        self.key = np.zeros(len(self.start), np.int64)
        for axis in self.cell:
            self.key = self.key * span + axis


def _unfolded(start: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows with ranges in batches of ``row, place``, a row for each place of its range."""
    keep = np.flatnonzero(count)
    start, count = start[keep], count[keep]
    ends = np.cumsum(count)
    done = 0
    while done < len(keep):
        before = ends[done - 1] if done else 0
        upto = max(done + 1, int(np.searchsorted(ends, before + _BATCH, "right")))
        n = count[done:upto]
        shift = start[done:upto] - (ends[done:upto] - n - before)
        yield np.repeat(keep[done:upto], n), np.arange(n.sum()) + np.repeat(shift, n)
        done = upto


class _Marks:
    """Which users on the left (rows) are near which on the right."""

    def __init__(self, left: _Side, right: _Side, metric: _Metric):
        self.left, self.right, self.metric = left, right, metric
        self.near = np.zeros((len(left.users), len(right.users)), bool)
        self.flat = self.near.reshape(-1)
        self.width = len(right.users)
        self.doubts: list[np.ndarray] = []

    def _points(self, l: np.ndarray, r: np.ndarray) -> None:
        """Marks pairs of points; those within rounding of the distance are left in doubt."""
        steps = [np.abs(a[l] - b[r]) for a, b in zip(self.left.at, self.right.at)]
        possible, sure = self.metric.judged(steps, steps)
        pair = self.left.user[l] * self.width + self.right.user[r]
        self.flat[pair[sure]] = True
        open_ = possible & ~sure
        if open_.any():
            self.doubts.append(np.stack([pair[open_], l[open_], r[open_]]))

    def _boxes(self, l: np.ndarray, r: np.ndarray) -> None:
        left, right = self.left, self.right
        least, greatest = [], []
        for axis in range(len(left.at)):
            up = left.hi[axis][l] - right.lo[axis][r]
            down = right.hi[axis][r] - left.lo[axis][l]
            greatest.append(np.maximum(up, down))
            least.append(np.maximum(0.0, np.maximum(-up, -down)))
        possible, sure = self.metric.judged(least, greatest)
        pair = left.box_user[l] * self.width + right.box_user[r]
        self.flat[pair[sure]] = True
        open_ = possible & ~self.flat[pair]
        l, r, pair = l[open_], r[open_], pair[open_]
        for row, spot in _unfolded(left.start[l], left.count[l]):
            for held, other in _unfolded(right.start[r[row]], right.count[r[row]]):
                still = ~self.flat[pair[row[held]]]
                self._points(spot[held[still]], other[still])

    def search(self, span: int) -> None:
        left, right = self.left, self.right
        for l_single, r_single in ((True, True), (False, False), (False, True), (True, False)):
            l_box = np.flatnonzero(left.single == l_single)
            r_box = np.flatnonzero(right.single == r_single)
            r_box = r_box[np.argsort(right.key[r_box], kind="stable")]
            if not len(l_box) or not len(r_box):
                continue
            keys = right.key[r_box]
            # Cells beside one another along the last axis are one range of keys.
            for around in itertools.product((-1, 0, 1), repeat=len(left.at) - 1):
                shift = 0
                for step in (*around, 0):
                    shift = shift * span + step
                middle = left.key[l_box] + shift
                start = np.searchsorted(keys, middle - 1, "left")
                count = np.searchsorted(keys, middle + 1, "right") - start
                for row, place in _unfolded(start, count):
                    l, r = l_box[row], r_box[place]
                    if l_single and r_single:
                        self._points(left.start[l], right.start[r])
                    else:
                        self._boxes(l, r)


def _sharing(left: pa.Array, right: pa.Array) -> Callable[[int], np.ndarray]:
    """For a user on the left, which on the right have any of the same values in their lists."""
    codes = pa.concat_arrays([left.flatten(), right.flatten()]).dictionary_encode().indices
    codes = codes.to_numpy(zero_copy_only=False)
    l_ends, r_counts = left.offsets.to_numpy(), np.diff(right.offsets.to_numpy())
    l_ends = l_ends - l_ends[0]
    mine, theirs = codes[: l_ends[-1]], codes[l_ends[-1]:]
    order = np.argsort(theirs, kind="stable")
    owner, theirs = np.repeat(np.arange(len(right)), r_counts)[order], theirs[order]
    known: dict[bytes, np.ndarray] = {}

    def among(row: int) -> np.ndarray:
        wanted = np.sort(mine[l_ends[row]:l_ends[row + 1]])
        name = wanted.tobytes()
        if name not in known:
            if len(known) >= 256:
                known.clear()
            found = np.zeros(len(right), bool)
            for a, b in zip(np.searchsorted(theirs, wanted, "left"),
                            np.searchsorted(theirs, wanted, "right")):
                found[owner[a:b]] = True
            known[name] = found
        return known[name]

    return among


def _barred(known: pa.Table, left: pa.Array, right: pa.Array, marks: _Marks) -> np.ndarray:
    """The places of known pairs in the table of marks, whichever of the two is on the left."""
    found = []
    for one, other in (("user_id", "_contact"), ("_contact", "user_id")):
        l = pc.index_in(known.column(one).combine_chunks(), value_set=left)
        r = pc.index_in(known.column(other).combine_chunks(), value_set=right)
        l, r = (pc.fill_null(at, -1).to_numpy().astype(np.int64) for at in (l, r))
        here = (l >= 0) & (r >= 0)
        found.append(l[here] * marks.width + r[here])
    return np.concatenate(found)


def near_in_blocks(
    rows: pa.Table, at: list[str], km: float, metric: str, check: bool
) -> Iterator[pa.RecordBatch]:
    """``at…, one, others, doubts``: a user of one block with those of the other that are near
    and share a value. Rows have ``at…, _l, _r, _own, user_id, shared, lat, lon``. Of pairs in
    doubt their points are given, to be measured by the caller. Where there is a column
    ``_contact``, rows that have one are pairs with ``user_id`` that are left out."""
    l_block, r_block = rows.column("_l")[0].as_py(), rows.column("_r")[0].as_py()
    known = None
    if "_contact" in rows.column_names:
        paired = pc.is_valid(rows.column("_contact"))
        known, rows = rows.filter(paired), rows.filter(pc.invert(paired))
        if not len(rows):
            return
    own = rows.column("_own").to_numpy()
    measure, same = _Metric(km, metric), l_block == r_block
    left = _Side(rows.filter(pa.array(own == l_block)), measure)
    right = _Side(rows.filter(pa.array(own == r_block)), measure)
    if not len(left.user) or not len(right.user):
        return
    origin = np.minimum(left.at.min(axis=1), right.at.min(axis=1))
    extent = (np.maximum(left.at.max(axis=1), right.at.max(axis=1)) - origin).max()
    cell = max(measure.reach * MARGIN, extent / _MOST_CELLS)
    span = int(extent / cell) + 4
    for side in (left, right):
        side.boxed(origin, cell, span)
    marks = _Marks(left, right, measure)
    marks.search(span)
    among = _sharing(left.shared, right.shared) if check else None
    barred = _barred(known, left.users, right.users, marks) if known is not None else None
    user = left.users.type
    spot = pa.struct([("other", user), *[(c, pa.float64()) for c in (
        "l_lat", "l_lon", "r_lat", "r_lon")]])
    named = rows.slice(0, 1).select(at).combine_chunks()

    open_of: dict[int, list] = {}
    if marks.doubts:
        pair, l, r = np.concatenate(marks.doubts, axis=1)
        still = ~marks.flat[pair]
        if barred is not None:
            still &= ~np.isin(pair, barred)
        for p, a, b in zip(pair[still], l[still], r[still]):
            i, j = divmod(int(p), marks.width)
            if (not same or j > i) and (among is None or among(i)[j]):
                open_of.setdefault(i, []).append(
                    (right.users[j].as_py(), left.lat[a], left.lon[a], right.lat[b], right.lon[b])
                )

    if barred is not None:
        marks.flat[barred] = False

    def given(ones: list[int], others: list[np.ndarray]) -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, others)]).astype(np.int32)
        near = right.users.take(pa.array(np.concatenate(others)))
        copies = pa.array(np.zeros(len(ones), np.int64))
        return pa.RecordBatch.from_arrays(
            [
                *[named.column(c).combine_chunks().take(copies) for c in at],
                left.users.take(pa.array(ones)),
                pa.ListArray.from_arrays(pa.array(ends), near),
                pa.array(
                    [[dict(zip(("other", "l_lat", "l_lon", "r_lat", "r_lon"), d))
                      for d in open_of.get(i, [])] for i in ones], pa.list_(spot),
                ),
            ],
            names=[*at, "one", "others", "doubts"],
        )

    ones, others, held = [], [], 0
    for i in range(len(left.users)):
        row = marks.near[i]
        if among is not None:
            row = row & among(i)
        found = np.flatnonzero(row[i + 1:]) + i + 1 if same else np.flatnonzero(row)
        if len(found) or i in open_of:
            ones.append(i)
            others.append(found)
            held += len(found)
        if held >= _BATCH:
            yield given(ones, others)
            ones, others, held = [], [], 0
    if ones:
        yield given(ones, others)
