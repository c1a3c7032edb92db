"""Repeatable samples of whole keys, and estimates from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BUCKETS = 16**8


def sample_users(
    df: DataFrame, fraction: float, key: str = "user_id", seed: int = 20,
    weight: str | None = None,
) -> DataFrame:
    """All rows of about ``fraction`` of the keys.

    A key is in or out by a hash of its value and the seed, so the choice does not depend on
    row order or partitioning, is the same in every table, and larger fractions contain the
    smaller ones. ``weight`` names an optional column with the number of keys each one stands
    for, for ``estimated_counts``.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie between 0 and 1")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    taken = int(fraction * _BUCKETS)
    sampled = df.where(F.col(key).isNotNull() & (bucket < taken))
    if not weight:
        return sampled
    return sampled.withColumn(weight, F.lit(_BUCKETS / taken if taken else None).cast("double"))


def estimated_counts(
    sampled: DataFrame, by: Sequence[str], key: str = "user_id", weight: str = "weight"
) -> DataFrame:
    """Per ``by`` the rows sampled, an unbiased ``estimate`` of all rows, and its
    ``standard_error``.

    Keys come into the sample by themselves and bring all their rows, so the spread of the
    estimate comes from how unevenly rows are spread over keys: it is the sum over the sampled
    keys of rows² · weight · (weight − 1). Rows are counted per key before they are weighed.
    """
    per_key = sampled.groupBy(*by, key, weight).agg(F.count(F.lit(1)).alias("_rows"))
    n, w = F.col("_rows").cast("double"), F.col(weight)
    return per_key.groupBy(*by).agg(
        F.sum("_rows").alias("sampled"),
        F.sum(n * w).alias("estimate"),
        F.sqrt(F.sum(n * n * w * (w - 1.0))).alias("standard_error"),
    )
