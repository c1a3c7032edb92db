"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of consecutive words, a window into shingles. A window
can only occur where all its shingles do, so it suffices to look for one of them: the rarest
in the corpus. Documents meet the windows on that necessary shingle, its place in the window
fixes where the window must start, and the words there are compared exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.shared import (
    BROADCAST_ROWS,
    ITEM_SEPARATORS,
    ITEM_SEPARATORS_CASED,
    ascii_lower,
    row_keys,
    small,
    stored,
    with_words,
    words_of,
)

WINDOW_WORDS = 13
SHINGLE_WORDS = 3

_ROW = ("k1", "k2")


def _shingle(words: str, at: Column, length: int) -> Column:
    """Hash of ``length`` words from position ``at`` (from 0)."""
    parts = [F.get(F.col(words), at + i) for i in range(length)]
    return F.xxhash64(F.lit(length), *parts)


def item_windows(benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``item_id, window, length``: every window of ``window`` words of each item, its words
    joined by spaces. An item of fewer words is one window; one of none, or without an id,
    has no window."""
    words = F.explode(F.array(words_of(ascii_lower(F.col("text")), ITEM_SEPARATORS)))
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", words.alias("words"))
    items = items.withColumn("n", F.size("words")).where("n > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.col("n") - window + 1, F.lit(1)))
    return items.select("item_id", "words", "n", F.explode(starts).alias("start")).select(
        "item_id",
        F.array_join(F.slice("words", F.col("start"), F.lit(window)), " ").alias("window"),
        F.least("n", F.lit(window)).alias("length"),
    )


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """``window, length, k, at, hash``: the shingles of each distinct window."""
    cut = windows.select("window", "length").distinct()
    cut = cut.select("*", F.split("window", " ").alias("words"))
    cut = cut.withColumn("k", F.least("length", F.lit(shingle)))
    at = F.explode(F.sequence(F.lit(0), F.col("length") - F.col("k"))).alias("at")
    cut = cut.select("window", "length", "words", "k", at)
    kind = F.lit(None).cast("long")
    for k in range(1, shingle + 1):
        kind = F.when(F.col("k") == k, _shingle("words", F.col("at"), k)).otherwise(kind)
    return cut.select("window", "length", "k", "at", kind.alias("hash"))


def _document_shingles(documents: DataFrame, size: int, window: int) -> DataFrame:
    """``k1, k2, n_words, pos, hash, around, first``: every shingle of ``size`` words, with the
    words that a window over it can reach, of which the first is word ``first``.

    No row carries the whole text, so a text of any length stays within memory.
    """
    texts = with_words(documents, ascii_lower(F.col("text")), ITEM_SEPARATORS)
    placed = texts.select(*_ROW, "words", "n_words", F.posexplode("words").alias("pos", "_word"))
    first = F.greatest(F.col("pos") - (window - 1), F.lit(0))
    return placed.where(F.col("pos") + size <= F.col("n_words")).select(
        *_ROW, "n_words", "pos", _shingle("words", F.col("pos"), size).alias("hash"),
        F.slice("words", first + 1, F.lit(2 * window - 1)).alias("around"),
        first.alias("first"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def window_matches(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW_WORDS,
    shingle: int = SHINGLE_WORDS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame | None:
    """``k1, k2, start, length, window``: every occurrence of a benchmark window.

    None if the benchmark has no window at all. The benchmark's shingles are broadcast where
    their counted number allows, and words are compared where they meet. With more of them the
    positions alone are shuffled, and what meets goes back to its document for the words.
    """
    shingles = stored(_window_shingles(item_windows(benchmark, window), shingle), "shingles")
    count, sizes = shingles.agg(F.count(F.lit(1)), F.collect_set("k")).first()
    if not count:
        return None
    grams = [_document_shingles(documents, size, window) for size in sorted(sizes)]

    # How often each of the benchmark's shingles occurs in the corpus; one that never does
    # rules its windows out.
    wanted = small(shingles.select("hash").distinct(), count, broadcast_rows)
    # One branch per size, joined on its own: there is hardly ever more than one.
    occurring = _union([g.select("hash").join(wanted, "hash") for g in grams])
    occurring = occurring.groupBy("hash").agg(F.count(F.lit(1)).alias("rows"))
    rarity = shingles.join(stored(occurring, "rarity"), "hash", "left")
    rarity = rarity.withColumn("rows", F.coalesce("rows", F.lit(0)))
    prefix = rarity.groupBy("window", "length").agg(
        F.min(F.struct("rows", "at", "hash")).alias("rarest")
    ).where("rarest.rows > 0")
    prefix = stored(prefix.select("window", "length", "rarest.at", "rarest.hash"), "prefix")

    start = F.col("pos") - F.col("at")
    fits = (start >= 0) & (start + F.col("length") <= F.col("n_words"))
    if count <= broadcast_rows:
        there = F.slice("around", start - F.col("first") + 1, F.col("length"))
        return _union([
            g.join(F.broadcast(prefix), "hash").where(fits)
            .where(F.array_join(there, " ") == F.col("window"))
            .select(*_ROW, start.alias("start"), "length", "window")
            for g in grams
        ])
    met = _union([g.drop("around", "first").join(prefix, "hash").where(fits) for g in grams])
    met = met.select(*_ROW, start.alias("start"), "length", "window").distinct()
    texts = documents.select(*row_keys(), "text").dropDuplicates(list(_ROW))
    words = F.explode(F.array(words_of(ascii_lower(F.col("text")), ITEM_SEPARATORS)))
    texts = texts.select(*_ROW, words.alias("words"))
    there = F.slice("words", F.col("start") + 1, F.col("length"))
    return met.join(texts, list(_ROW)).where(
        F.array_join(there, " ") == F.col("window")
    ).select(*met.columns)


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW_WORDS,
    shingle: int = SHINGLE_WORDS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``doc_id, k1, k2, n_words, n_hit, item_ids`` per row of ``documents``.

    A word inside any occurrence of a window is hit; ``item_ids`` are the distinct ids, as
    strings in order, of the items with an occurring window. Null and empty texts have no
    words and are not hit; benchmark rows without an id or without words take no part; rows
    that repeat are each returned; documents of null id are judged like any other; all
    columns but ``doc_id``, ``text`` and ``item_id``, ``text`` are ignored.
    """
    documents = documents.select("doc_id", "text")
    counted = documents.select(
        "doc_id", *row_keys(),
        F.size(words_of(F.col("text"), ITEM_SEPARATORS_CASED)).cast("long").alias("n_words"),
    )
    matches = window_matches(documents, benchmark, window, shingle, broadcast_rows)
    if matches is None:
        return counted.select(
            "*", F.lit(0).cast("long").alias("n_hit"),
            F.array().cast("array<string>").alias("item_ids"),
        )
    matches = stored(matches, "matches")
    spans = matches.groupBy(*_ROW, "start").agg(F.max("length").alias("length"))
    end = F.col("start") + F.col("length")
    before = (
        Window.partitionBy(*_ROW).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0)))
    hits = (
        spans.select(*_ROW, F.greatest(end - reached, F.lit(0)).alias("new"))
        .groupBy(*_ROW)
        .agg(F.sum("new").cast("long").alias("n_hit"))
    )
    owners = item_windows(benchmark, window).select(
        "window", F.col("item_id").cast("string").alias("item_id")
    ).distinct()
    owners = stored(owners, "owners")
    items = (
        matches.select(*_ROW, "window").distinct()
        .join(small(owners, owners.count(), broadcast_rows), "window")
        .groupBy(*_ROW)
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    )
    return (
        counted.join(hits.join(items, list(_ROW)), list(_ROW), "left")
        .select(
            "doc_id", *_ROW, "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
    )


def is_contaminated() -> Column:
    """A twentieth of the words or more are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
