"""Mixing sources to target weights.

The words of a source's documents, end to end, are packed into blocks of fixed length. Every
output shard draws its number of blocks per source from a multinomial distribution over what
the sources still owe. The slots a source was given are mapped through pseudorandom
permutations of its blocks, one for each time it is gone through, and joined to the blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.shared import (
    SPACES,
    quoted,
    row_keys,
    running_start,
    small,
    stored,
    words_of,
)

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
REPEATS = 2.0
BLOCK_WORDS = 64
SHARDS = 64
SEED = 20240501
# Sources whose counts one task draws; with very many sources it is as many as there are such
# groups, so that neither a task nor the driver holds them all.
GROUP_SOURCES = 1_024
# Slots a task expands.
TASK_SLOTS = 100_000
# Slots a row is expanded to at once.
_STEP = 4_096


def mixing_targets(
    sizes: Sequence[float], weights: Sequence[float], share: float, repeats: float
) -> list[float]:
    """Words to take from each source: ``share`` of all words dealt out by weight, no source
    more than ``repeats`` times its size; what it cannot give is dealt out again."""
    targets = [0.0] * len(sizes)
    active = list(range(len(sizes)))
    budget = share * sum(sizes)
    while active:
        per_weight = budget / sum(weights[s] for s in active)
        above = [s for s in active if weights[s] * per_weight > repeats * sizes[s]]
        if not above:
            for s in active:
                targets[s] = weights[s] * per_weight
            break
        for s in above:
            targets[s] = repeats * float(sizes[s])
            budget -= targets[s]
        active = [s for s in active if s not in set(above)]
    return targets


def draw_counts(
    totals: np.ndarray, shards: int, seed: int | Sequence[int], dues: Sequence[int] | None = None
) -> np.ndarray:
    """Blocks per shard and source (shards × sources).

    Each shard has its even part of all blocks, or as many as ``dues`` says, and draws them
    from a multinomial distribution over the blocks not yet dealt. What a source no longer has
    is drawn again from the others, so all blocks are dealt in the end.
    """
    rng = np.random.default_rng(seed)
    left = totals.astype(np.int64).copy()
    counts = np.zeros((shards, len(left)), np.int64)
    for shard in range(shards):
        due = int(left.sum()) // (shards - shard) if dues is None else int(dues[shard])
        while due:
            drawn = np.minimum(rng.multinomial(due, left / left.sum()), left)
            counts[shard] += drawn
            left -= drawn
            due -= int(drawn.sum())
    return counts


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Four multiples of the golden ratio's fraction, one for each round.
_TURNS = [np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64) for turn in range(4)]


def permuted(index: np.ndarray, count: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a keyed permutation of ``0 … count-1`` takes ``index`` (arrays of one length).

    Four rounds of a Feistel network over the least even number of bits that holds ``count``;
    a result beyond ``count`` goes through again until it is within.
    """
    x, n, key = (np.asarray(a).astype(np.uint64) for a in (index, count, key))
    bits = np.ceil(np.log2(np.maximum(n, 2).astype(float)) + 1e-9)
    half = np.maximum(1, np.ceil(bits / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    todo = np.arange(len(x))
    while len(todo):
        h, m = half[todo], mask[todo]
        left, right = x[todo] >> h, x[todo] & m
        for turn in _TURNS:
            f = _mixed(right + key[todo] + turn)
            left, right = right, left ^ (f & m)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= n[todo]]
    return x.astype(np.int64)


def source_sizes(documents: DataFrame) -> DataFrame:
    """``doc_id, source, size, k1, k2``: words between white space of each document."""
    words = F.size(words_of(F.col("text"), SPACES)).cast("long")
    return documents.select("doc_id", "source", words.alias("size"), *row_keys())


def source_targets(
    per_source: DataFrame, weights: Sequence[float], share: float, repeats: float
) -> DataFrame:
    """``source, source_size, rank, target`` of ``source, size``; the same targets as
    ``mixing_targets`` for any number of sources.

    In each round Spark adds up what the sources that cannot give their part do give, and which
    weights are left; the part per weight follows from these sums, which are whole numbers, and
    only grows until no source is added.
    """
    last = F.col("source").isNull()
    ranked = running_start(
        per_source.withColumns({"_last": last, "_one": F.lit(1)}), [], ["_last", "source"],
        "_one", "rank",
    ).select("source", F.col("size").alias("source_size"), F.col("rank").cast("long"))
    ranked = stored(ranked, "sources")
    nth = (F.col("rank") % len(weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), nth + 1)
    cannot = lambda part: weight * part > repeats * F.col("source_size")
    whole = ranked.agg(F.sum("source_size")).first()[0] or 0
    part, short = 0.0, -1
    while True:
        above = cannot(F.lit(part))
        sums = ranked.agg(
            F.count_if(above).alias("short"),
            F.sum(F.when(above, F.col("source_size")).otherwise(0)).alias("given"),
            *[F.count_if(~above & (nth == n)).alias(f"left_{n}") for n in range(len(weights))],
        ).first()
        left = sum(w * sums[f"left_{n}"] for n, w in enumerate(weights))
        if sums["short"] == short or not left:
            break
        short = sums["short"]
        part = (share * whole - repeats * (sums["given"] or 0)) / left
    target = F.when(cannot(F.lit(part)), repeats * F.col("source_size")).otherwise(weight * part)
    return ranked.withColumn("target", target)


def source_draws(sources: DataFrame, shards: int, seed: int) -> tuple[DataFrame, int]:
    """``shard, rank, begin, count, blocks``: which of a source's ``total`` blocks each shard
    gets, and how many there are in all.

    Groups of sources are drawn first, as if each were one source, and what a shard draws of a
    group is then drawn from its sources, group by group in tasks.
    """
    found = sources.agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("total")).first()
    of_group = max(GROUP_SOURCES, int(found["n"] ** 0.5))
    grouped = sources.select(
        F.floor(F.col("rank") / of_group).alias("group"), "rank", "blocks", "total"
    )
    totals = grouped.groupBy("group").agg(F.sum("total").alias("total")).orderBy("group").collect()
    counts = draw_counts(np.array([r["total"] for r in totals], np.int64), shards, seed)
    dues = sources.sparkSession.createDataFrame(
        [(r["group"], counts[:, n].tolist()) for n, r in enumerate(totals)],
        "group long, dues array<long>",
    )

    def draw(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("rank")
        group = int(own["group"].iloc[0])
        drawn = draw_counts(own["total"].to_numpy(), shards, [seed, group], own["dues"].iloc[0])
        begins = np.cumsum(drawn, axis=0) - drawn
        shard, at = np.nonzero(drawn)
        return pd.DataFrame({
            "shard": shard.astype(np.int32), "rank": own["rank"].to_numpy()[at],
            "begin": begins[shard, at], "count": drawn[shard, at],
            "blocks": own["blocks"].to_numpy()[at],
        })

    # At most so many sources come together in a group.
    drawn = grouped.join(dues, "group").groupBy("group").applyInPandas(
        draw, "shard int, rank long, begin long, count long, blocks long"
    )
    return stored(drawn, "draws"), found["total"] or 0


class Mix:
    """The result of a mixing: what it was given and what it takes.

    ``documents``: ``doc_id, k1, k2, size, source, source_size, target, rank, start`` per row,
    ``start`` being its first word's place in its source. ``pieces``: ``shard, slot, rank,
    block, turn, start, first_word, n_words``, the run of words of the document at ``start``
    that the block in that slot holds; ``turn`` counts how often the source was gone through.
    """

    def __init__(self, documents: DataFrame, pieces: DataFrame):
        self.documents = documents
        self.pieces = pieces

    def taken(self) -> DataFrame:
        """``documents`` with ``taken``: the words the mix takes of each, repeats counted."""
        per_document = self.pieces.groupBy("rank", "start").agg(F.sum("n_words").alias("taken"))
        # A document without words starts where the next one does, and is given none.
        filled = self.documents.where("size > 0").join(per_document, ["rank", "start"], "left")
        empty = self.documents.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
        return filled.withColumn("taken", F.coalesce("taken", F.lit(0))).unionByName(empty)


def mix_sources(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    repeats: float = REPEATS,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = SEED,
) -> Mix:
    """Mix all ``documents`` (``doc_id, text, source``) to the targets of their sources.

    Sources in code point order, null last, take the weights in turn. A source that is to be
    gone through ``c`` times in part gives every block ``c`` or ``c - 1`` times. Null texts
    and those without words have size 0 and are never taken. The same input gives the same
    mix, however it is partitioned; rows that repeat each have their own place. Other columns
    are ignored; an empty table gives an empty mix. Sources may be any number.
    """
    sized = stored(source_sizes(documents), "sizes")
    per_source = stored(sized.groupBy("source").agg(F.sum("size").alias("size")), "per-source")
    size = F.col("source_size")
    blocks = F.ceil(size / block_words)
    total = F.when(size > 0, F.round(blocks * F.col("target") / size)).otherwise(0)
    sources = stored(
        source_targets(per_source, weights, share, repeats).withColumns(
            {"blocks": blocks.cast("long"), "total": total.cast("long")}
        ),
        "targets",
    )
    named = small(
        sources.select(F.col("source").alias("_source"), "rank", "source_size", "target"),
        sources.count(),
    )
    ranked = sized.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = stored(running_start(ranked, ["rank"], ["doc_id", "k1", "k2"], "size", "start"),
                    "placed")

    end = F.col("start") + F.col("size")
    covers = F.sequence(
        F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words)
    )
    runs = placed.where("size > 0").select(
        "rank", "start", "size", F.explode(covers).alias("block")
    )
    first = F.greatest(F.col("block") * block_words - F.col("start"), F.lit(0))
    last = F.least((F.col("block") + 1) * block_words - F.col("start"), F.col("size"))
    runs = runs.select(
        "rank", "block", "start", first.alias("first_word"), (last - first).alias("n_words")
    )

    drawn, n_slots = source_draws(sources, shards, seed)
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1, F.lit(_STEP).cast("long")))
    # Few rows that become many: as many tasks as the slots need, whatever the rows weigh.
    steps = drawn.select("*", step.alias("at")).repartition(
        n_slots // TASK_SLOTS + 1, "shard", "rank", "at"
    )
    within = F.sequence(F.col("at"), F.least(F.col("at") + _STEP, F.col("count")) - 1)
    slots = steps.select("shard", "rank", "blocks", "begin", F.explode(within).alias("slot"))
    number = F.col("begin") + F.col("slot")
    slots = slots.select(
        "shard", "rank", "slot", "blocks",
        F.floor(number / F.col("blocks")).alias("turn"),
        (number % F.col("blocks")).alias("index"),
    )

    @F.pandas_udf("long")
    def block_at(rank: pd.Series, turn: pd.Series, index: pd.Series, count: pd.Series) -> pd.Series:
        given = (rank.to_numpy(np.uint64) << np.uint64(32)) + turn.to_numpy(np.uint64)
        key = _mixed(given + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64))
        return pd.Series(permuted(index.to_numpy(), count.to_numpy(), key))

    slots = slots.select(
        "shard", "slot", "rank", "turn", block_at("rank", "turn", "index", "blocks").alias("block")
    )
    # Slots are expanded from a few rows, which makes them look small enough to broadcast.
    return Mix(placed, slots.hint("merge").join(runs, ["rank", "block"]))


def mixed_documents(documents: DataFrame, **settings) -> DataFrame:
    """The mix as documents: for each turn that takes words of a document, one row with its
    columns and the taken words as text. A text taken whole is left as it is, parts are joined
    by spaces. ``n_chars``, where it is a column, counts the new text."""
    columns = documents.columns
    mix = mix_sources(documents, **settings)
    turns = mix.pieces.groupBy("rank", "start", "turn").agg(
        F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("pieces"),
        F.sum("n_words").alias("taken"),
    )
    # Rows that repeat share their keys and are told apart by their number among them.
    nth = F.row_number().over(Window.partitionBy("k1", "k2", "source").orderBy("start"))
    chosen = (
        mix.documents.withColumn("nth", nth).where("size > 0")
        .join(turns, ["rank", "start"])
        .select("k1", "k2", "source", "nth", "size", "turn", "pieces", "taken")
    )
    nth = F.row_number().over(Window.partitionBy("k1", "k2", "source").orderBy(F.lit(0)))
    given = documents.select(F.struct(*quoted(columns)).alias("row"), "source", *row_keys())
    given = given.withColumn("nth", nth)
    keys = ["k1", "k2", "nth"]
    met = given.join(
        chosen.withColumnRenamed("source", "their_source"),
        keys,
    ).where(F.col("source").eqNullSafe(F.col("their_source")))
    words = words_of(F.col("row.text"), SPACES)
    met = met.select("row", "size", "taken", "pieces", F.explode(F.array(words)).alias("words"))
    parts = F.flatten(F.transform(
        "pieces",
        lambda p: F.slice("words", (p["first_word"] + 1).cast("int"), p["n_words"].cast("int")),
    ))
    text = F.when(F.col("taken") == F.col("size"), F.col("row.text")).otherwise(
        F.array_join(parts, " ")
    )
    out = met.select("row", text.alias("text"))
    return out.select(*[
        F.col("text") if c == "text"
        else F.length("text").cast("long").alias(c) if c == "n_chars"
        else F.col("row").getField(c).alias(c)
        for c in columns
    ])
