"""SimHash near-duplicates, linked with the help of a pivot distance table.

A table of Hamming distances to reference fingerprints bounds every distance from below: two
fingerprints are no closer than their largest difference in any coordinate. By itself the
bound can only discard pairs, and distances to 64-bit references lie so close together that it
passes nearly half of unrelated pairs per reference, so that many references are needed; which
pairs are held against each other is decided by exact equality on parts of the fingerprint.
Fingerprints a few bits apart agree on all but as many of the parts, so every link meets. The
table is computed once per fingerprint and stored. Within the rows that meet, ordered by the
first coordinate, only those within reach are taken, pairs with any coordinate too far apart
are discarded, and the survivors are verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.components import components
from waymark.llm.shared import quoted, row_keys, stored, tidy

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
# Parts a fingerprint is cut into, and reference fingerprints of the distance table.
PARTS = 6
PIVOTS = 32
# Fingerprints that share the same parts and are held against each other by one task.
CELL_ROWS = 2_048


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """64 bits, each set where over half of the shingles' hashes have it set.

    Words lie between white space, A-Z lowered; a shingle is ``shingle`` of them joined by
    spaces, fewer words are one shingle, none give zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(ends + 1).tolist()]
    ends = [*ends.tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    last = min(shingle, len(words)) - 1
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[last:])]
    counts = _bit_counts(np.array(hashes, "<u8"))
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, lowest first.

    Counts of up to 255 hashes fit in the bytes of a 64-bit number, eight bits at a time.
    """
    lanes = np.uint64(0x0101010101010101)
    counts = np.zeros((8, 8), np.int64)
    for at in range(0, len(hashes), 255):
        some = hashes[at : at + 255]
        for bit in range(8):
            packed = ((some >> np.uint64(bit)) & lanes).sum(dtype=np.uint64)
            counts[:, bit] += np.frombuffer(packed.tobytes(), np.uint8)
    return counts.reshape(64)


def fingerprints(documents: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, k1, k2, fp`` (the fingerprint as a signed 64-bit number) per row."""
    given = documents.select("doc_id", *row_keys(), "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array(
                [fingerprint(t.as_py(), shingle) for t in batch.column(3)], np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(marks.view("i8"))],
                ["doc_id", "k1", "k2", "fp"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(tidy(hashed), f"doc_id {kind}, k1 long, k2 long, fp long")


def pivot_fingerprints(pivots: int) -> np.ndarray:
    """Reference fingerprints spread evenly by hashing their number."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % n) for n in range(pivots)], np.uint64)


def pivot_distances(fps: np.ndarray, references: np.ndarray) -> np.ndarray:
    """The distance table: fingerprints × references."""
    return np.bitwise_count(fps[:, None] ^ references[None, :]).astype(np.int8)


def distance_table(fps: DataFrame, pivots: int) -> DataFrame:
    """``fp, d0, table``: of each fingerprint the distances to all references, a byte each, and
    the first of them."""
    references = pivot_fingerprints(pivots)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            table = pivot_distances(marks.view(np.uint64), references)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(table[:, 0].astype(np.int16)),
                 pa.array([row.tobytes() for row in table], pa.binary())],
                ["fp", "d0", "table"],
            )

    return fps.select("fp").mapInArrow(tidy(measured), "fp long, d0 short, table binary")


def passed(table: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Of pairs of rows those that no coordinate of the table discards, by number."""
    left = np.arange(len(a))
    for coordinate in range(1, table.shape[1]):
        if not len(left):
            break
        own = table[a[left], coordinate] - table[b[left], coordinate]
        left = left[np.abs(own) <= bits]
    return left


def linked_rows(
    cell: np.ndarray, fps: np.ndarray, table: np.ndarray, bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of a forest that links the rows of each cell just as all pairs would.

    Rows are in order of cell, then of the first coordinate. Every row is held against the
    one ``step`` further on, for growing steps, until that is of another cell or out of reach.
    """
    root = np.arange(len(fps))
    ones, others = [], []
    at = np.arange(len(fps) - 1)
    step = 1
    while len(at):
        near = at + step
        keep = near < len(fps)
        at, near = at[keep], near[keep]
        keep = (cell[at] == cell[near]) & (table[near, 0] - table[at, 0] <= bits)
        at, near = at[keep], near[keep]
        keep = passed(table, at, near, bits)
        a, b = at[keep], near[keep]
        keep = np.bitwise_count(fps[a] ^ fps[b]) <= bits
        a, b = a[keep], b[keep]
        keep = root[a] != root[b]
        if keep.any():
            for x, y in zip(a[keep].tolist(), b[keep].tolist()):
                p, q = _root(root, x), _root(root, y)
                if p != q:
                    root[max(p, q)] = min(p, q)
                    ones.append(x)
                    others.append(y)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
        step += 1
    return np.array(ones, np.int64), np.array(others, np.int64)


def _root(root: np.ndarray, row: int) -> int:
    while root[row] != row:
        row = root[row]
    return row


def part_masks(parts: int) -> list[int]:
    """Masks that cut 64 bits into parts of nearly equal width."""
    edges = [round(64 * n / parts) for n in range(parts + 1)]
    return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def linked_fingerprints(
    fps: DataFrame, bits: int = MAX_BITS, parts: int = PARTS, pivots: int = PIVOTS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``a, b``: links among distinct fingerprints ``fp`` that connect all that are linked by
    ``bits`` or fewer differing bits, and no others.

    Fingerprints meet under each choice of ``parts - bits`` parts. A choice shared by more
    than ``cell_rows`` of them is cut into blocks, and every two blocks meet in a cell of their
    own, so no task holds more than two blocks at a time and still all pairs meet.
    """
    masks = part_masks(parts)
    chosen = [sum(masks[p] for p in group) for group in combinations(range(parts), parts - bits)]
    keys = F.explode(F.array(*[
        F.struct(
            F.lit(n).cast("short").alias("choice"),
            F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("part"),
        )
        for n, mask in enumerate(chosen)
    ])).alias("k")
    spread = fps.select("fp", keys).select("fp", "k.choice", "k.part")
    counted = spread.groupBy("choice", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counted = stored(counted, "shared-parts")
    # At most one choice in two rows is left; the others link to nothing by that choice.
    met = spread.join(counted, ["choice", "part"])
    blocks = F.ceil(F.col("n") / F.lit(cell_rows)).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    # With one block the cell is (0, 0); else a block meets each other one, and itself in the
    # cells it shares with them.
    other = F.when(blocks == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), blocks - 1), lambda o: o != own)
    )
    cells = met.select("fp", "choice", "part", own.alias("own"), F.explode(other).alias("other"))
    cells = cells.select(
        "fp", "choice", "part",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
    )
    # Of those that meet at all; the others need no distances.
    table = stored(distance_table(met.select("fp").distinct(), pivots), "distances")
    cell = ["choice", "part", "low", "high"]
    ordered = (
        cells.join(table, "fp")
        .select("fp", F.xxhash64(*cell).alias("cell"), *cell, "d0", "table")
        .repartition(*cell)
        .sortWithinPartitions("cell", *cell, "d0", "fp")
        .select("fp", *cell, "table")
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            got = [batch.column(n).to_numpy(zero_copy_only=False) for n in range(5)]
            held_bytes = b"".join(batch.column(5).to_pylist())
            got.append(np.frombuffer(held_bytes, np.int8).reshape(-1, pivots))
            if held is not None:
                got = [np.concatenate(pair) for pair in zip(held, got)]
            if not len(got[0]):
                continue
            # The last cell may go on in the next batch; it is no longer than two blocks.
            starts = _cell_numbers(got)
            cut = int(np.searchsorted(starts, starts[-1]))
            yield from emit([g[:cut] for g in got])
            held = [g[cut:] for g in got]
        if held is not None:
            yield from emit(held)

    def _cell_numbers(got: list[np.ndarray]) -> np.ndarray:
        new = np.zeros(len(got[0]), bool)
        for column in got[1:5]:
            new[1:] |= column[1:] != column[:-1]
        return np.cumsum(new)

    def emit(got: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        marks = got[0].astype(np.int64).view(np.uint64)
        if len(marks) < 2:
            return
        a, b = linked_rows(_cell_numbers(got), marks, got[5], bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(marks[a].view(np.int64)), pa.array(marks[b].view(np.int64))], ["a", "b"]
        )

    return ordered.mapInArrow(tidy(link), "a long, b long")


def near_duplicates(
    documents: DataFrame, shingle: int = SHINGLE_WORDS, bits: int = MAX_BITS,
    parts: int = PARTS, pivots: int = PIVOTS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``doc_id, k1, k2, fp, root, component_id`` per row of ``documents``.

    Documents whose fingerprints differ in ``bits`` or fewer bits are linked; ``root`` is the
    least fingerprint reachable and ``component_id`` the smallest id of any document reachable,
    itself included. Null texts and those without words have fingerprint zero and are linked
    like any other. Null ids take part and are never a component's id unless all are null;
    rows that repeat are each returned; other columns are ignored.
    """
    hashed = stored(fingerprints(documents, shingle), "fingerprints")
    # Copies count once; a fingerprint shared by a third of all rows is one row from here on.
    distinct = stored(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    links = linked_fingerprints(distinct.select("fp"), bits, parts, pivots, cell_rows)
    roots = components(links).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = stored(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root")
    return hashed.join(named, "fp").select("doc_id", "k1", "k2", "fp", "root", "component_id")


def one_of_each(documents: DataFrame, **settings) -> DataFrame:
    """``documents`` with one row of each group of near-duplicates: that of the smallest id,
    or, where all ids are null, of the least text by hash. Columns stay as they are."""
    columns = documents.columns
    found = near_duplicates(documents, **settings)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ranks = Window.partitionBy("root", F.col("doc_id").isNull()).orderBy("doc_id", "k1", "k2")
    kept = found.where(stays).withColumn("nth", F.row_number().over(ranks)).where("nth = 1")
    given = documents.select(F.struct(*quoted(columns)).alias("row"), *row_keys())
    met = given.join(kept.select("k1", "k2"), ["k1", "k2"], "left_semi")
    # Rows that repeat in id and text are one document.
    nth = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.lit(0)))
    return met.withColumn("nth", nth).where("nth = 1").select("row.*")
