"""Sharding by vector bin packing.

Documents of equal text form a group with a size vector of bytes, tokens and rows. Groups are
placed, largest first, where the dot product of their vector with what a shard has left is
highest. Few groups can be large: those above a fixed part of a shard are packed in one go,
which bounds their number by the shard count and not by the input. The small ones are dealt
into buckets of bounded size that are packed side by side, each into its share of what the
large ones have left.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.shared import SPACES, stored, words_of

SHARDS = 40
# Parts a group of equal texts is counted in, so that no task has to number all its rows.
SALTS = 1024
# A group above this part of a shard is split by salt; one above the smaller part is large.
SPLIT_PART = 0.5
LARGE_PART = 1 / 512
BUCKET_ITEMS = 4096

# Weights of the three measures in the dot product. Bytes come first: a short document is far
# more of its shard's rows than of its bytes, and would else even out the rows alone.
WEIGHTS = (100.0, 1.0, 1.0)

_SIZES = ("bytes", "tokens", "rows")


def _pack(
    items: pd.DataFrame, totals: np.ndarray, left: np.ndarray, weights: np.ndarray, turn: int
) -> np.ndarray:
    """The shard of each item; ``left`` (shards × 3) is what each shard can still take.

    Sizes count in parts of the total, times the weight of their measure. Ties go to the first
    shard, counted from ``turn`` on.
    """
    scale = np.sqrt(weights) / totals
    sizes = items[list(_SIZES)].to_numpy(float) * scale
    left = np.roll(left * scale, -turn, axis=0)
    order = np.lexsort((items["salt"], items["grp"], -items["rows"], -items["bytes"]))
    shard = np.zeros(len(items), np.int32)
    for at in order:
        best = int((left @ sizes[at]).argmax())
        left[best] -= sizes[at]
        shard[at] = (best + turn) % len(left)
    return shard


def pack_shards(
    documents: DataFrame,
    shards: int = SHARDS,
    salts: int = SALTS,
    split_part: float = SPLIT_PART,
    large_part: float = LARGE_PART,
    bucket_items: int = BUCKET_ITEMS,
    weights: tuple[float, float, float] = WEIGHTS,
) -> DataFrame:
    """``doc_id, size, tokens, text_crc32, shard, slot`` per row of ``documents``.

    ``size`` is the text's UTF-8 bytes and 16 more, ``tokens`` its words between white space.
    Bytes, tokens and rows of the shards come out nearly equal; equal texts share a shard
    unless they exceed ``split_part`` of one, when they are cut by a hash of their id. Slots
    count the rows of a shard from 0 without a gap. A null text is its own group, of no bytes
    and no tokens, with the checksum of no bytes; ids may be null or repeat; other columns are
    ignored; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    # One hash of 128 bits tells texts apart; null and empty differ.
    group = F.concat(F.md5(text), F.when(F.col("text").isNull(), "n").otherwise("t"))
    measured = stored(
        documents.select(
            "doc_id",
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.size(words_of(F.col("text"), SPACES)).cast("long").alias("tokens"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            group.alias("grp"),
            F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("part"),
        ),
        "measured",
    )
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
            F.count(F.lit(1)).alias("rows")]
    total = measured.agg(*sums).first()
    if not total["rows"]:
        return measured.select(
            "doc_id", "size", "tokens", "text_crc32", F.lit(0).alias("shard"),
            F.lit(0).cast("long").alias("slot"),
        )
    totals = np.array([max(1, total[c]) for c in _SIZES], float)
    share = totals / shards
    weighed = np.array(weights, float)

    def part_of_shard(*columns: str):
        return F.greatest(*[F.col(c) / F.lit(float(s)) for c, s in zip(columns, share)])

    # A group has at most ``salts`` cells, so its window is bounded.
    whole = Window.partitionBy("grp")
    cells = measured.groupBy("grp", "part").agg(*sums)
    cells = cells.withColumns({f"all_{c}": F.sum(c).over(whole) for c in _SIZES})
    split = part_of_shard(*[f"all_{c}" for c in _SIZES]) > split_part
    cells = stored(
        cells.withColumn("salt", F.when(split, F.col("part")).otherwise(-1)).select(
            "grp", "part", "salt", *_SIZES
        ),
        "cells",
    )
    items = cells.groupBy("grp", "salt").agg(*[F.sum(c).alias(c) for c in _SIZES])
    items = stored(items.withColumn("large", part_of_shard(*_SIZES) > large_part), "items")
    small_sums = items.where("NOT large").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SIZES], F.count(F.lit(1)).alias("n")
    ).first()
    buckets = max(1, math.ceil(small_sums["n"] / bucket_items))
    small_totals = np.array([max(1, small_sums[c]) for c in _SIZES], float)
    schema = "grp string, salt int, rows long, bucket int, shard int, bytes long, tokens long"
    columns = [c.split()[0] for c in schema.split(", ")]

    def pack_large(found: pd.DataFrame) -> pd.DataFrame:
        left = np.repeat(share[None, :], shards, axis=0)
        return found.assign(bucket=-1, shard=_pack(found, totals, left, weighed, 0))[columns]

    # Bounded: no more than shards / large_part groups for each of the three measures.
    large = stored(
        items.where("large").groupBy().applyInPandas(pack_large, schema), "large"
    )
    taken = np.zeros((shards, len(_SIZES)))
    for row in large.groupBy("shard").agg(*[F.sum(c).alias(c) for c in _SIZES]).collect():
        taken[row["shard"]] = [row[c] for c in _SIZES]
    left_over = share[None, :] - taken

    def pack_small(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        own = found[list(_SIZES)].sum().to_numpy(float)
        left = left_over * (own / small_totals)
        shard = _pack(found, totals, left, weighed, key[0] % shards)
        return found.assign(bucket=key[0], shard=shard)[columns]

    bucket = F.pmod(F.xxhash64("grp", "salt"), F.lit(buckets)).cast("int")
    dealt = (
        items.where("NOT large").withColumn("bucket", bucket).groupBy("bucket")
        .applyInPandas(pack_small, schema)
    )
    placed = stored(large.unionByName(dealt), "placed").select("grp", "salt", "bucket", "shard")

    # Slots: rows before the bucket in its shard, before the cell in its bucket, in the cell.
    placed_cells = cells.join(placed, ["grp", "salt"]).select(
        "grp", "part", "shard", "bucket", F.col("rows").alias("cell_rows")
    )
    placed_cells = stored(placed_cells, "placed-cells")
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    in_shard = ahead(Window.partitionBy("shard").orderBy("bucket"))
    per_bucket = placed_cells.groupBy("shard", "bucket").agg(F.sum("cell_rows").alias("n"))
    per_bucket = per_bucket.select(
        "shard", "bucket", F.coalesce(F.sum("n").over(in_shard), F.lit(0)).alias("before")
    )
    in_bucket = ahead(Window.partitionBy("shard", "bucket").orderBy("grp", "part"))
    offset = F.col("before") + F.coalesce(F.sum("cell_rows").over(in_bucket), F.lit(0))
    starts = placed_cells.join(per_bucket, ["shard", "bucket"]).select(
        "grp", "part", "shard", offset.alias("start")
    )
    in_cell = Window.partitionBy("grp", "part").orderBy("doc_id")
    numbered = measured.withColumn("place", F.row_number().over(in_cell))
    return numbered.join(starts, ["grp", "part"]).select(
        "doc_id", "size", "tokens", "text_crc32", "shard",
        (F.col("start") + F.col("place") - 1).alias("slot"),
    )
