"""Many-to-many equi-joins whose keys may be very unevenly filled."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one side that share a key and are still matched by a single task.
BLOCK_ROWS = 4096


def block_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str] | Mapping[str, Sequence[str]],
    condition: Column,
    block_rows: int = BLOCK_ROWS,
    ordered: bool = False,
) -> DataFrame:
    """``left`` inner join ``right`` on ``keys`` and ``condition``, hot keys cut into blocks.

    A key with more than ``block_rows`` rows on a side has that side dealt into blocks by a
    hash of the ``spread`` columns, and each block of one side meets each block of the other
    under a key of its own. Every pair of rows still meets exactly once, while no task is
    left with more than a block by a block. Keys below the limit are joined as they are.

    ``ordered`` says that both sides hold the same rows and that the condition wants the first
    spread column greater on the left. Blocks are then ranges of that column, and a block only
    meets itself and those below it: half of the meetings of a hot key.

    ``left`` and ``right`` must be disjoint in column names but for ``keys``; the spread
    columns are named with the prefix of their side, ``l_`` and ``r_``, and are the same on
    both sides if not given per prefix.
    """
    present = lambda left_rows, right_rows: [
        F.lit(left_rows).alias("_n_left"), F.lit(right_rows).alias("_n_right")
    ]
    counted = (
        left.select(*keys, *present(1, 0))
        .unionByName(right.select(*keys, *present(0, 1)))
        .groupBy(*keys)
        .agg(F.sum("_n_left").alias("_n_left"), F.sum("_n_right").alias("_n_right"))
    )
    if ordered:
        return _ordered_blocks(left, right, keys, spread[0], condition, counted, block_rows)
    by = spread if isinstance(spread, Mapping) else {"l_": spread, "r_": spread}
    blocks = lambda name: F.ceil(F.col(name) / block_rows).cast("int")
    # Keys over the limit on a side; at most one for every block_rows rows of input.
    hot = counted.where(
        (F.least("_n_left", "_n_right") > 0) & (F.greatest("_n_left", "_n_right") > block_rows)
    ).select(*keys, blocks("_n_left").alias("_blocks_l"), blocks("_n_right").alias("_blocks_r"))

    def dealt(side: DataFrame, own: str, other: str, prefix: str) -> DataFrame:
        with_counts = side.join(hot, list(keys), "left").withColumns(
            {n: F.coalesce(n, F.lit(1)) for n in ("_blocks_l", "_blocks_r")}
        )
        mine = F.pmod(F.xxhash64(*[prefix + c for c in by[prefix]]), F.col(f"_blocks_{own}"))
        others = F.explode(F.sequence(F.lit(0), F.col(f"_blocks_{other}") - 1))
        return with_counts.withColumns(
            {f"_{own}": mine.cast("int"), f"_{other}": others}
        ).drop("_blocks_l", "_blocks_r")

    lefts = dealt(left, "l", "r", "l_")
    rights = dealt(right, "r", "l", "r_")
    return lefts.join(rights, [*keys, "_l", "_r"]).where(condition).drop("_l", "_r")


# Ranges a hot key is cut into at most; what is then still over the limit is cut by hash too.
_RANGES = 100


def _ordered_blocks(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    by: str,
    condition: Column,
    counted: DataFrame,
    block_rows: int,
) -> DataFrame:
    blocks = F.ceil(F.col("_n_left") / block_rows)
    hot = counted.where(F.col("_n_left") > block_rows).select(
        *keys, blocks.cast("int").alias("_blocks")
    )
    # The ranges are cut at quantiles, which need only be rough: whatever the edges, each pair
    # of rows has exactly one meeting.
    steps = [n / _RANGES for n in range(1, _RANGES)]
    quantiles = (
        left.join(hot, list(keys), "left_semi")
        .groupBy(*keys)
        .agg(F.percentile_approx(f"l_{by}", steps, 1000).alias("_quantiles"))
    )
    ranges = F.least("_blocks", F.lit(_RANGES))
    edge = lambda b: F.element_at("_quantiles", F.floor(b * _RANGES / ranges).cast("int"))
    cuts = hot.join(quantiles, list(keys)).select(
        *keys,
        F.array_distinct(F.transform(F.sequence(F.lit(1), ranges - 1), edge)).alias("_edges"),
        F.ceil(F.col("_blocks") / _RANGES).cast("int").alias("_parts"),
    )

    def dealt(side: DataFrame, prefix: str, own: str, other: str) -> DataFrame:
        placed = side.join(cuts, list(keys), "left").withColumn(
            "_parts", F.coalesce("_parts", F.lit(1))
        )
        value = F.col(f"{prefix}{by}")
        below = F.size(F.filter("_edges", lambda e: e < value))
        at = F.when(F.col("_edges").isNull(), 0).otherwise(below)
        last = F.when(F.col("_edges").isNull(), 0).otherwise(F.size("_edges"))
        # Greater values are on the left, so a left range meets those up to its own.
        met = F.sequence(F.lit(0), at) if prefix == "l_" else F.sequence(at, last)
        return (
            placed.withColumn(own, at)
            .withColumn(f"{own}_part", F.pmod(F.xxhash64(value), "_parts").cast("int"))
            .withColumn(other, F.explode(met))
            .withColumn(f"{other}_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
            .drop("_edges", "_parts")
        )

    cells = ["_l", "_r", "_l_part", "_r_part"]
    lefts, rights = dealt(left, "l_", "_l", "_r"), dealt(right, "r_", "_r", "_l")
    return lefts.join(rights, [*keys, *cells]).where(condition).drop(*cells)


def without_edges(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (``user_left, user_right, …``) no edge (``user_id, contact_id``)
    leads along.

    Pairs that are formed block by block, and are as their operator gave them, are formed without
    these, so that the edges are moved and the pairs are not. Others are joined with the edges.
    """
    formed = vars(pairs).get("_formed_without")
    if formed is not None and _same_ids(pairs, edges):
        return formed(edges)
    known = edges.select(
        F.col("user_id").alias("user_left"), F.col("contact_id").alias("user_right")
    )
    return pairs.join(known, ["user_left", "user_right"], "left_anti")


def formed_without(formed: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
    """The pairs ``formed(None)``, which ``without_edges`` replaces by those it gives of edges."""
    pairs = formed(None)
    pairs._formed_without = formed
    return pairs


def _same_ids(pairs: DataFrame, edges: DataFrame) -> bool:
    kinds = [pairs.schema[c].dataType for c in ("user_left", "user_right")]
    return kinds == [edges.schema[c].dataType for c in ("user_id", "contact_id")]
