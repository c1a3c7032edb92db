"""Daily presence and runs of consecutive days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_presence(message_city: DataFrame) -> DataFrame:
    """One row per user, city and day, with the last message time of that day.

    Grouping on all three keys with map-side combine turns a user of any number of messages
    into at most one row per city and day before anything is gathered by user.
    """
    return message_city.groupBy("user_id", "city", "date").agg(
        F.max("datetime").alias("datetime")
    )


def day_streaks(
    presence: DataFrame, keys: Sequence[str] = ("user_id", "city"), max_gap_days: int = 1
) -> DataFrame:
    """Runs of days at most ``max_gap_days`` apart, per ``keys``.

    Returns the keys with ``first_date``, ``last_date``, ``last_action`` and ``days`` (days
    with presence). Rows are partitioned by the first key alone, which also satisfies the
    window, the grouping and every later step per user: one exchange serves them all.
    """
    by_day = Window.partitionBy(*keys).orderBy("date")
    gap = F.datediff("date", F.lag("date").over(by_day))
    starts = F.when(gap > max_gap_days, 1).otherwise(0)
    return (
        presence.repartition(keys[0])
        .withColumn("_starts", starts)
        .withColumn(
            "_run", F.sum("_starts").over(by_day.rowsBetween(Window.unboundedPreceding, 0))
        )
        .groupBy(*keys, "_run")
        .agg(
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            F.max("datetime").alias("last_action"),
            F.count(F.lit(1)).alias("days"),
        )
        .drop("_run")
    )


def merge_streaks(
    *runs: DataFrame, keys: Sequence[str] = ("user_id", "city"), max_gap_days: int = 1
) -> DataFrame:
    """Runs of several sets of days as the runs of all their days together.

    Each set has the columns of ``day_streaks``, and no day of a key is in two of them. Runs
    that meet, or reach into each other, become one; the order of the sets is no matter, and
    merged runs can be merged again. Rows are partitioned as by ``day_streaks``.
    """
    whole = runs[0]
    for more in runs[1:]:
        whole = whole.unionByName(more)
    in_order = Window.partitionBy(*keys).orderBy("first_date", "last_date")
    so_far = F.max("last_date").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(F.datediff("first_date", so_far) > max_gap_days, 1).otherwise(0)
    return (
        whole.repartition(keys[0])
        .withColumn("_starts", starts)
        .withColumn(
            "_run", F.sum("_starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
        )
        .groupBy(*keys, "_run")
        .agg(
            F.min("first_date").alias("first_date"),
            F.max("last_date").alias("last_date"),
            F.max("last_action").alias("last_action"),
            F.sum("days").alias("days"),
        )
        .drop("_run")
    )


def advance_streaks(
    state: DataFrame,
    presence: DataFrame,
    keys: Sequence[str] = ("user_id", "city"),
    max_gap_days: int = 1,
) -> DataFrame:
    """The runs of ``state`` carried on by the ``presence`` of days it does not know yet.

    A daily rerun reads its new days and the runs so far, of which there are far fewer than
    days, in place of the whole history.
    """
    new = day_streaks(presence, keys, max_gap_days)
    return merge_streaks(state, new, keys=keys, max_gap_days=max_gap_days)
