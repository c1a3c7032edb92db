"""Whitening of embeddings on MLlib block matrices.

Vectors are brought onto a grid of whole numbers, so that what they have in common (number,
sums, deviations) is exact. Rows are numbered and centred and become a distributed
``BlockMatrix``. Its transpose times itself is the scatter matrix, of which only a square of
the dimension comes to the driver, for the eigenvectors. The matrix times the whitening matrix
projects all rows; the same for the fit list gives the error of the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.shared import small, stored

COMPONENTS = 16
# The grid: steps per unit, and what is added so that usual entries are positive.
STEPS = 64
SHIFT = 1_000_000
# Entries further out than this many steps count as this far out.
FARTHEST = 2**60
BLOCK_ROWS = 1_024
BLOCK_COLUMNS = 1_024
# Blocks that one task multiplies and adds up before sums of tasks are added up.
TASK_BLOCKS = 32
# Rows of one block matrix, whose row numbers have to stay within 31 bits.
PANEL_ROWS = 2**29

_OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


@dataclass
class Whitening:
    """What is learnt from the fit list: ``n`` vectors with ``sums`` per dimension, the
    eigenvalues in falling order with the unit eigenvectors as columns, and the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def sound(self) -> np.ndarray:
        """Which components have a spread beyond rounding, and so can be brought to one."""
        rounding = len(self.values) * np.finfo(float).eps * max(self.values.max(), 0.0)
        return self.values > rounding

    def matrix(self) -> np.ndarray:
        """Centred rows times this are whitened; a column of zeros where there is no spread."""
        scale = np.where(self.sound(), self.values, 1.0)
        return np.where(self.sound(), self.vectors / np.sqrt(scale), 0.0)


def on_grid(embeddings: DataFrame) -> DataFrame:
    """``vec_id, x``: vectors of finite entries, each as whole steps of the grid.

    Vectors are of one length, the most frequent one (the greater of equally frequent ones);
    those of any other cannot be compared with them and are left out, as are empty ones.
    """
    entry = lambda c: F.floor(
        F.least(F.greatest(c.cast("double") * STEPS, F.lit(-float(FARTHEST))), F.lit(float(FARTHEST)))
    ) + F.lit(SHIFT).cast("long")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    v = F.col("embedding")
    sound = F.coalesce((F.size(v) > 0) & F.forall(v, finite), F.lit(False))
    vectors = embeddings.where(sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, entry).alias("x")
    )
    lengths = vectors.groupBy(F.size("x").alias("dim")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("dim")).first()
    return vectors.where(F.size("x") == (usual["dim"] if usual else 0))


class _Numbered:
    """Rows with a number of their own, in panels whose numbers fit a block matrix.

    A row is told by the partition that wrote it and its place there. The numbers of a
    partition begin after those of all before it, which takes a row per partition to add up.
    """

    def __init__(self, rows: DataFrame, panel_rows: int):
        at = F.monotonically_increasing_id().bitwiseAND(2**33 - 1)
        self.rows = stored(
            rows.select("*", F.spark_partition_id().alias("part"), at.alias("at")), "vectors"
        )
        parts = self.rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
        ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        start = F.coalesce(F.sum("rows").over(ahead), F.lit(0).cast("long"))
        parts = parts.select("part", "rows", start.alias("start")).withColumn(
            "panel", F.floor(F.col("start") / panel_rows)
        )
        base = F.min("start").over(Window.partitionBy("panel"))
        self._parts = stored(parts.withColumn("start", F.col("start") - base), "parts")
        self._n_parts = self._parts.count()

    def panels(self) -> Iterator[tuple[DataFrame, int]]:
        """``number`` and the columns of the rows, panel by panel, with the count of numbers."""
        found = self._parts.groupBy("panel").agg(
            F.min("part").alias("a"), F.max("part").alias("b"), F.sum("rows").alias("rows")
        )
        for p in sorted(found.collect()):
            part = F.col("part").between(p["a"], p["b"])
            starts = small(self._parts.where(part).select("part", "start"), self._n_parts)
            rows = self.rows.where(part).join(starts, "part")
            yield rows.withColumn("number", F.col("start") + F.col("at")).drop("start"), p["rows"]


def _apart(fit: Whitening) -> Column:
    """``n * x - sums`` in whole numbers; null beyond 64 bits."""
    sums = F.array(*[F.lit(s if abs(s) < 2**63 else None).cast("long") for s in fit.sums])
    return F.zip_with("x", sums, lambda x, s: F.try_subtract(F.try_multiply(x, F.lit(fit.n)), s))


def _from_mean(fit: Whitening) -> Column:
    """Entries of ``x`` less their mean, taken apart in whole numbers while these fit."""
    means = F.array(*[F.lit(s / fit.n) for s in fit.sums])
    plain = F.zip_with("x", means, lambda x, m: x.cast("double") - m)
    return F.zip_with(_apart(fit), plain, lambda w, p: F.coalesce(w.cast("double") / fit.n, p))


def _deviation(fit: Whitening) -> Column:
    """Sum of squares of ``n * x - sums``, exact; null beyond 64 bits."""
    return F.aggregate(
        _apart(fit), F.lit(0).cast("long"),
        lambda total, a: F.try_add(total, F.try_multiply(a, a)),
    )


def _block_matrix(rows: DataFrame, entries: Column, n_rows: int, dim: int) -> BlockMatrix:
    """The rows of a panel as a distributed block matrix; numbers without a row are zeros."""
    vectors = rows.select(F.col("number").alias("index"), array_to_vector(entries).alias("vector"))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n_rows, dim)
    return indexed.toBlockMatrix(BLOCK_ROWS, min(dim, BLOCK_COLUMNS))


def _gram(blocks: BlockMatrix, n_rows: int) -> np.ndarray:
    """Transpose times the matrix itself: a square of the dimension.

    The sums over rows are split, so that tasks multiply ``TASK_BLOCKS`` blocks each and only
    their small products come together; else all rows would meet in the result's one task.
    """
    splits = max(1, -(-n_rows // (BLOCK_ROWS * TASK_BLOCKS)))
    transposed = blocks.transpose()
    product = transposed._java_matrix_wrapper.call(
        "multiply", blocks._java_matrix_wrapper._java_model, splits
    )
    whole = BlockMatrix(product, transposed.rowsPerBlock, blocks.colsPerBlock)
    return whole.toLocalMatrix().toArray()


def _local(spark: SparkSession, matrix: np.ndarray, like: BlockMatrix) -> BlockMatrix:
    """A matrix of the driver, of a row per dimension, cut to be multiplied by ``like``."""
    rows = spark.sparkContext.parallelize(
        [(n, Vectors.dense(row)) for n, row in enumerate(matrix)], 1
    )
    indexed = IndexedRowMatrix(rows, *matrix.shape)
    return indexed.toBlockMatrix(like.colsPerBlock, matrix.shape[1])


def _fit_list(numbered: _Numbered, panel_rows: int) -> _Numbered:
    """Each distinct ``x`` once."""
    return _Numbered(numbered.rows.select("x").distinct(), panel_rows)


def fit_whitening(fit: _Numbered) -> Whitening | None:
    """Number, sums and eigenvectors of a fit list; None of an empty one."""
    counted = fit.rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("x").cast("decimal(20,0)")).alias("total")
    )
    found = sorted(counted.collect())
    if not found:
        return None
    n, dim = found[0]["n"], len(found)
    none = np.zeros(dim)
    fitted = Whitening(n, [int(r["total"]) for r in found], none, np.eye(dim), 0.0)
    scatter = np.zeros((dim, dim))
    for rows, n_rows in fit.panels():
        scatter += _gram(_block_matrix(rows, _from_mean(fitted), n_rows, dim), n_rows)
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    falling = np.argsort(values)[::-1]
    fitted.values, fitted.vectors = np.maximum(values[falling], 0.0), vectors[:, falling]
    fitted.trace = float(np.trace(covariance))
    return fitted


def _projected(
    numbered: _Numbered, fit: Whitening, matrix: np.ndarray
) -> Iterator[tuple[DataFrame, BlockMatrix, int]]:
    """Per panel its rows, their projections as a block matrix, and the count of numbers."""
    for rows, n_rows in numbered.panels():
        blocks = _block_matrix(rows, _from_mean(fit), n_rows, len(fit.sums))
        yield rows, blocks.multiply(_local(rows.sparkSession, matrix, blocks)), n_rows


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, panel_rows: int = PANEL_ROWS
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row per
    vector (``vec_id, embedding``) and component, the first of which spread most.

    Vectors that are null, empty, or hold null or non-finite entries are left out, as are those
    not of the usual length (``on_grid``). Repeated rows, and null ids, stay as they are. The
    fit list has each distinct vector once, however many copies there are. Entries beyond
    2**60 steps count as those; ``deviation`` is null where it passes 64 bits. A component
    without spread has null for ``whitened``, and no part in ``identity_error``, which is null
    if there is no other; ``explained`` is null if no component has any. An empty table gives
    no rows. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    numbered = _Numbered(on_grid(embeddings), panel_rows)
    distinct = _fit_list(numbered, panel_rows)
    fit = fit_whitening(distinct)
    if fit is None:
        return spark.createDataFrame([], _OUT)
    kept = min(components, len(fit.sums))
    matrix, sound = fit.matrix()[:, :kept], fit.sound()[:kept]

    square = np.zeros((kept, kept))
    for _, projected, n_rows in _projected(distinct, fit, matrix):
        square += _gram(projected, n_rows)
    apart = np.abs(square / fit.n - np.eye(kept))[np.ix_(sound, sound)]
    error = float(apart.max()) if apart.size else None

    explained = [float(v / fit.trace) if fit.trace > 0 else None for v in fit.values[:kept]]
    parts = []
    for rows, projected, _ in _projected(numbered, fit, matrix):
        model = projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model
        whitened = callMLlibFunc("getIndexedRows", model).select(
            F.col("index").alias("number"), vector_to_array("vector").alias("whitened")
        )
        parts.append(
            rows.select("number", "vec_id", _deviation(fit).alias("deviation"))
            .join(whitened, "number")
            .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        )
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    at = F.col("at")
    pick = lambda values, kind: F.element_at(
        F.array(*[F.lit(v).cast(kind) for v in values]), at + 1
    )
    return found.select(
        "vec_id",
        (at + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        F.when(pick(sound.tolist(), "boolean"), F.col("whitened")).alias("whitened"),
        pick(explained, "double").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
