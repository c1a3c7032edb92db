"""Pairs of users: shared interest and direct contact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.events import MESSAGE, SUBSCRIPTION
from waymark.operators.blocks import BLOCK_ROWS, block_join, without_edges

# Channels of a user that are held in one row.
MOST_CHANNELS = 64

# Chunks that a block of users is made of, about.
_CHUNKS = 8
# Tasks for each core of the session.
_TASKS = 16


def subscriptions(events: DataFrame) -> DataFrame:
    """``user_id, channel``, each once."""
    return (
        events.where(F.col("event_type") == SUBSCRIPTION)
        .select(
            F.col("event.user").alias("user_id"),
            F.col("event.subscription_channel").alias("channel"),
        )
        .distinct()
    )


def channel_members(user_geo: DataFrame, events: DataFrame) -> DataFrame:
    """``user_id, city, channel``: subscribers with the home city they live in."""
    homes = user_geo.select("user_id", F.col("home_city").alias("city"))
    return homes.join(subscriptions(events), "user_id")


def shared_groups(user_geo: DataFrame, events: DataFrame) -> DataFrame:
    """``channel, city, user_id, members``: who follows a channel in a city, with how many.

    A group stands for all pairs of its members, ``members * (members - 1) / 2`` links, in as
    many rows as it has members. The count is taken by partial sums and joined back, so no group
    is gathered; groups of one link nobody and are left out.
    """
    followers = channel_members(user_geo, events).where(
        F.col("channel").isNotNull() & F.col("city").isNotNull()
    )
    sizes = followers.groupBy("channel", "city").agg(F.count(F.lit(1)).alias("members"))
    return followers.join(sizes.where(F.col("members") > 1), ["channel", "city"]).select(
        "channel", "city", "user_id", "members"
    )


def group_links(groups: DataFrame) -> DataFrame:
    """``channel, city, members, links`` of each group: its pairs, counted and not formed."""
    n = F.col("members")
    return groups.select("channel", "city", "members").distinct().withColumn(
        "links", F.floor(n * (n - 1) / 2)
    )


def _chunks(groups: DataFrame, rows: int) -> DataFrame:
    """``city, channels, users``: users of one city who follow just the same channels, in arrays
    of about ``rows`` at most; those of more than ``MOST_CHANNELS`` are left out."""
    user = F.col("user_id").isNotNull()
    alike = (
        groups.where(user).groupBy("city", "user_id")
        .agg(F.sort_array(F.collect_set("channel")).alias("channels"))
        .where(F.size("channels") <= MOST_CHANNELS)
    )
    key = ["city", "channels"]
    parts = alike.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / rows).alias("_parts"))
    part = F.pmod(F.xxhash64("user_id"), "_parts")
    return (
        alike.join(parts, key).groupBy(*key, part.alias("_part"))
        .agg(F.collect_list("user_id").alias("users")).drop("_part")
    )


def _pairs_of_chunks(groups: DataFrame, block_rows: int) -> DataFrame:
    """The pairs of users of few channels. Chunks meet under their first common channel alone,
    and each pair of users is in one pair of chunks, so none is formed twice."""
    at = ["city", "channel"]
    placed = _chunks(groups, max(1, block_rows // _CHUNKS)).select(
        "city", "channels", "users", F.explode("channels").alias("channel")
    )
    # A chunk is named by its least user, who is in no other of the city.
    placed = placed.withColumn("chunk", F.array_min("users"))
    blocks = F.ceil(F.sum(F.size("users")) / block_rows).cast("int").alias("_blocks")
    dealt = placed.join(placed.groupBy(*at).agg(blocks), at).withColumn(
        "_own", F.pmod(F.xxhash64("chunk"), "_blocks").cast("int")
    )

    def side(prefix: str, cells: list[Column]) -> DataFrame:
        named = [F.col(c).alias(prefix + c) for c in ("channels", "users", "chunk")]
        cut = dealt.select(*at, *named, *cells)
        # Cells are small and make many pairs, so how many tasks there are is not left to sizes.
        tasks = _TASKS * max(1, groups.sparkSession.sparkContext.defaultParallelism)
        return cut.repartition(tasks, *at, "_l", "_r")

    # Of two blocks the higher one is on the left.
    lefts = side("l_", [
        F.col("_own").alias("_l"), F.explode(F.sequence(F.lit(0), "_own")).alias("_r")
    ])
    rights = side("r_", [
        F.explode(F.sequence(F.col("_own"), F.col("_blocks") - 1)).alias("_l"),
        F.col("_own").alias("_r"),
    ])
    once = (F.col("_l") > F.col("_r")) | (F.col("l_chunk") >= F.col("r_chunk"))
    first = F.array_min(F.array_intersect("l_channels", "r_channels")) == F.col("channel")
    met = lefts.join(rights, [*at, "_l", "_r"]).where(once & first)
    pairs = met.select(
        "city", "l_users", "r_users", (F.col("l_chunk") == F.col("r_chunk")).alias("same")
    ).select("city", "same", "r_users", F.explode("l_users").alias("l_user")).select(
        "city", "same", "l_user", F.explode("r_users").alias("r_user")
    ).where(~F.col("same") | (F.col("l_user") > F.col("r_user")))
    return pairs.select(
        F.greatest("l_user", "r_user").alias("user_left"),
        F.least("l_user", "r_user").alias("user_right"),
        "city",
    )


def _pairs_of_busy(groups: DataFrame, busy: DataFrame, block_rows: int) -> DataFrame:
    """The pairs in which either user is among ``busy``, ``city, user_id``."""
    side = lambda df, prefix: df.select(
        "channel", "city", F.col("user_id").alias(f"{prefix}user_id"), *(
            [] if prefix == "l_" else ["busy"])
    )
    known = groups.join(busy.withColumn("busy", F.lit(True)), ["city", "user_id"], "left")
    l_user, r_user = F.col("l_user_id"), F.col("r_user_id")
    once = F.when(F.col("busy"), l_user > r_user).otherwise(l_user != r_user)
    pairs = block_join(
        side(known.where("busy"), "l_"), side(known, "r_"), keys=["channel", "city"],
        spread=["user_id"], condition=once, block_rows=block_rows,
    )
    return pairs.select(
        F.greatest(l_user, r_user).alias("user_left"), F.least(l_user, r_user).alias("user_right"),
        "city",
    ).distinct()


def expand_groups(groups: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``user_left, user_right, city``: the pairs that groups stand for, each once, the larger
    id on the left.

    Users with the same channels are linked to the same others, so they are matched together:
    what is joined are chunks of such users, which then unfold to pairs, and nothing is moved
    after that. A group with much of a large city is matched in blocks over many tasks. Users
    of very many channels are matched channel by channel, and their pairs made distinct.
    """
    of_user = groups.where(F.col("user_id").isNotNull()).groupBy("city", "user_id")
    busy = of_user.agg(F.countDistinct("channel").alias("_n")).where(F.col("_n") > MOST_CHANNELS)
    pairs = _pairs_of_chunks(groups, block_rows)
    busy = busy.select("city", "user_id")
    if busy.isEmpty():
        return pairs
    return pairs.unionByName(_pairs_of_busy(groups, busy, block_rows))


def shared_channel_pairs(
    user_geo: DataFrame, events: DataFrame, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``user_left, user_right, city``: pairs with a channel and the home city in common.

    Each pair is given once, the larger id on the left. These are the groups of followers,
    expanded; what only needs to know who is linked can stay with the groups.
    """
    return expand_groups(shared_groups(user_geo, events), block_rows)


def direct_contacts(events: DataFrame) -> DataFrame:
    """``user_left, user_right``: users with a direct message either way, each pair once,
    the larger id on the left. An addressee of 0 or NULL is no contact."""
    sender, addressee = F.col("event.message_from"), F.col("event.message_to")
    return (
        events.where((F.col("event_type") == MESSAGE) & (addressee > 0) & sender.isNotNull())
        .select(
            F.greatest(sender, addressee).alias("user_left"),
            F.least(sender, addressee).alias("user_right"),
        )
        .distinct()
    )


def contact_edges(events: DataFrame) -> DataFrame:
    """``user_id, contact_id``: the same contacts as a symmetric edge set, both ways.

    The log is read and made distinct once in the ordered form, then turned round.
    """
    left, right = F.col("user_left"), F.col("user_right")
    edge = lambda a, b: F.struct(a.alias("user_id"), b.alias("contact_id"))
    both = F.when(left == right, F.array(edge(left, right))).otherwise(
        F.array(edge(left, right), edge(right, left))
    )
    return direct_contacts(events).select(F.inline(both))


def exclude_contacts(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """The pairs no edge connects; ``edges`` is symmetric, as from ``contact_edges``.

    Pairs as ``near_pairs`` gives them are formed without the edges and not moved.
    """
    return without_edges(pairs, edges)
