"""Packing of tokenised documents into sequences of a fixed capacity.

How pieces are put together depends on their lengths alone, of which there are no more than
the capacity. So the table of how many pieces there are of each length is packed, in runs of
equal sequences: an index of the sums of one, two and three available lengths gives, for the
gap beside a long piece, lengths that fill it exactly, consumed as often as all of them are
available; what has no complement goes where it fits best. The plan says which pieces of a
length, counted through, go where; Spark counts the pieces through and looks them up in it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.shared import slices, small, stored, tidy
from waymark.llm.token_files import END_ID, encoder

CAPACITY = 2048


class Sums:
    """Which sums one, two and three of the available lengths have, while counts change."""

    def __init__(self, top: int):
        self.counts = np.zeros(top + 1, np.int64)
        # Of each sum the pairs of available lengths, a length with itself if there are two.
        self._pairs = np.zeros(2 * top + 1, np.int64)

    def change(self, length: int, by: int) -> None:
        before = int(self.counts[length])
        after = before + by
        self.counts[length] = 0
        if bool(before) != bool(after):
            self._pairs[length + np.flatnonzero(self.counts)] += 1 if after else -1
        if (before > 1) != (after > 1):
            self._pairs[2 * length] += 1 if after > 1 else -1
        self.counts[length] = after

    def complement(self, gap: int) -> list[int] | None:
        """One, two or three available lengths with the sum ``gap``, as few as do, and of these
        the ones with the greatest length."""
        if self.counts[gap]:
            return [gap]
        if self._pairs[gap]:
            return self._pair(gap)
        one = np.arange(gap - 2, 0, -1)
        for a in one[(self.counts[one] > 0) & (self._pairs[gap - one] > 0)].tolist():
            # The pair must do without this one.
            self.change(a, -1)
            pair = self._pair(gap - a) if self._pairs[gap - a] else None
            self.change(a, 1)
            if pair:
                return [a, *pair]
        return None

    def _pair(self, total: int) -> list[int]:
        greater = np.arange(total - 1, (total - 1) // 2, -1)
        smaller = total - greater
        left = (self.counts[greater] > 0) & (self.counts[smaller] > (greater == smaller))
        at = int(np.flatnonzero(left)[0])
        return [int(greater[at]), int(smaller[at])]


def plan_sequences(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Runs of equal sequences, as (how many, lengths in each), that use up ``counts``."""
    sums = Sums(capacity)
    for length, n in counts.items():
        sums.change(length, n)
    runs: list[tuple[int, list[int]]] = []
    left_over: dict[int, int] = {}
    # The longest first: of those left it has the fewest ways to be completed.
    for length in range(capacity, 0, -1):
        while n := int(sums.counts[length]):
            sums.change(length, -1)
            filling = sums.complement(capacity - length) if length < capacity else []
            sums.change(length, 1)
            if filling is None:
                left_over[length] = n
                sums.change(length, -n)
                break
            needed = Counter([length, *filling])
            times = min(int(sums.counts[part]) // k for part, k in needed.items())
            for part, k in needed.items():
                sums.change(part, -k * times)
            runs.append((times, [length, *filling]))
    return runs + _best_fit(left_over, capacity)


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Longest first, each piece into the fullest sequence that has room; sequences that hold
    the same are handled together."""
    by_gap: dict[int, list[tuple[int, list[int]]]] = {}

    def hold(times: int, held: list[int]) -> None:
        if times:
            by_gap.setdefault(capacity - sum(held), []).append((times, held))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            gap = min((g for g, some in by_gap.items() if some and g >= length), default=None)
            if gap is None:
                fresh, rest = divmod(left, capacity // length)
                hold(fresh, [length] * (capacity // length))
                hold(1 if rest else 0, [length] * rest)
                break
            times, held = by_gap[gap].pop()
            if left < times:
                hold(times - left, held)
                hold(left, [*held, length])
                break
            more = min(gap // length, left // times)
            hold(times, held + [length] * more)
            left -= more * times
    return [run for some in by_gap.values() for run in some]


class _Places:
    """Where the pieces of each length go, by their number among those of that length."""

    def __init__(self, runs: list[tuple[int, list[int]]], capacity: int):
        used = [0] * (capacity + 1)
        rows = []
        sequence = 0
        for times, lengths in runs:
            at = 0
            for length, k in Counter(lengths).items():
                rows.append((length, used[length], sequence, k, at))
                used[length] += k * times
                at += k * length
            sequence += times
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        self._lengths, self._first, self._sequence, self._each, self._at = table.T.copy()
        self._begins = np.searchsorted(self._lengths, np.arange(capacity + 2))

    def of(self, lengths: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequences and offsets of pieces."""
        row = np.empty(len(nth), np.int64)
        for length in np.unique(lengths).tolist():
            a, b = self._begins[length], self._begins[length + 1]
            own = lengths == length
            row[own] = a + np.searchsorted(self._first[a:b], nth[own], "right") - 1
        k = nth - self._first[row]
        each = self._each[row]
        return self._sequence[row] + k // each, self._at[row] + k % each * lengths


_PIECE_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
    ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary()),
    ("part", pa.int32()), ("nth", pa.int64()),
])
_PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, "
    "nth long"
)


def cut_pieces(
    documents: DataFrame, tokenizer: str, capacity: int, end_id: int, keep_ids: bool
) -> DataFrame:
    """The pieces of every document, with the task ``part`` that cut them and their number
    ``nth`` among those of the same length that it cut before."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        own = encoder(tokenizer)
        end = np.array([end_id], "<u4")
        met = [0] * (capacity + 1)
        for batch in batches:
            for some in slices(batch):
                texts = [t or "" for t in some.column(1).to_pylist()]
                rows: list[tuple] = []
                for doc_id, data in zip(some.column(0).to_pylist(), own.encode(texts)):
                    ids = np.concatenate([np.frombuffer(data, own.dtype).astype("<u4"), end])
                    start, piece = 0, 0
                    stop = len(ids) % capacity or capacity
                    while start < len(ids):
                        held = ids[start:stop].tobytes()
                        length = stop - start
                        rows.append((
                            doc_id, piece, start, length, zlib.crc32(held),
                            held if keep_ids else None, part, met[length],
                        ))
                        met[length] += 1
                        start, stop, piece = stop, stop + capacity, piece + 1
                if rows:
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECE_SCHEMA)]
                    yield pa.RecordBatch.from_arrays(columns, schema=_PIECE_SCHEMA)

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.mapInArrow(tidy(cut), _PIECES)
    return found if keep_ids else found.drop("ids")


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece, and with
    ``keep_ids`` its ``ids``, 32-bit little-endian numbers end to end.

    A document is the ids of its whole text and ``end_id``; a null text is an empty one. Only
    documents longer than the capacity are cut, into pieces of the capacity, the first of which
    may be shorter. Null and repeated ids, and repeated rows, are documents like others; an
    empty table gives no rows; other columns are ignored. Pieces are written once to the shared
    folder; the table of lengths, of as many rows as the capacity, is all that is planned on
    the driver, and the plan has a few rows per length whatever the input.
    """
    pieces = stored(cut_pieces(documents, tokenizer, capacity, end_id, keep_ids), "pieces")
    per_task = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()
    places = _Places(plan_sequences({r["length"]: r["n"] for r in counts}, capacity), capacity)
    # Pieces of a length are counted through task by task: a row per task and length is added
    # up, never a row per piece.
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    first = per_task.select("part", "length", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
    counted = pieces.join(small(first, per_task.count()), ["part", "length"])
    columns = [c for c in pieces.columns if c not in ("part", "nth")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, nth = batch.columns
            length = batch.column(columns.index("length")).to_numpy()
            sequence, offset = places.of(length, nth.to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                [*columns, "sequence_id", "offset"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema}
    out = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", sequence_id long, offset long"
    nth = (F.col("first") + F.col("nth")).alias("nth")
    return counted.select(*columns, nth).mapInArrow(tidy(place), out)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids`` of pieces packed with ``keep_ids``: each sequence's ids end
    to end, as many as the capacity at most."""
    held = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.transform(held, lambda p: p["ids"]).alias("_ids")
    ).select("sequence_id", "length", F.aggregate(
        "_ids", F.lit(b""), lambda joined, ids: F.concat(joined, ids)
    ).alias("ids"))
