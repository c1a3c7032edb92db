"""License scans by diagonal voting.

Every rolling word k-gram of a document meets the positions of the same k-gram in the
templates. A match votes for the diagonal ``document position - template position``; words
inserted or left out move a text over to a neighbouring diagonal, so neighbours are merged.
Runs of a template that follow each other, in the document and in the template, with not too
many words between them are one span. It is verified by its words: a vote counts only where the
words of the k-gram stand, and a span if enough of its template's words stand in it. Short
phrases are templates of a single k-gram, whose every vote is a place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.shared import (
    ITEM_SEPARATORS,
    ITEM_SEPARATORS_CASED,
    ascii_lower,
    row_keys,
    with_words,
    words_of,
)

# Words per k-gram of a long template, diagonals a run may drift between matches, words of
# something else that may stand between runs of a span, and the part of a template's words
# that must stand in it.
GRAM_WORDS = 5
DRIFT = 4
GAP_WORDS = 64
COVERAGE = 0.6

# Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# The customary notices of public licenses.
NOTICES = (
    (
        "mit-notice",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the "
        "Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions",
    ),
    (
        "apache-notice",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    (
        "bsd-notice",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    (
        "cc-by-notice",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    (
        "isc-notice",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies",
    ),
    (
        "mpl-notice",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    (
        "unlicense-notice",
        "This is free and unencumbered software released into the public domain. Anyone is free "
        "to copy, modify, publish, use, compile, sell, or distribute this software, either in "
        "source code form or as a compiled binary, for any purpose, commercial or non-commercial, "
        "and by any means",
    ),
)

_ROW = ("k1", "k2")


def _templates(spark: SparkSession, phrases: Sequence, notices: Sequence, gram: int) -> DataFrame:
    """``label, phrase, grams, k, at, gram``: every k-gram of every template.

    The templates are literals of the program, so their number is bounded by its text.
    """
    rows = [(label, text, True) for text, label in phrases]
    rows += [(label, text, False) for label, text in notices]
    given = F.array(*[
        F.struct(
            F.lit(n).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text"),
            F.lit(phrase).alias("phrase"),
        )
        for n, (label, text, phrase) in enumerate(rows)
    ])
    words = F.explode(F.array(words_of(ascii_lower(F.col("t.text")), ITEM_SEPARATORS)))
    found = spark.range(1).select(F.explode(given).alias("t")).select("t.*", words.alias("words"))
    found = found.withColumn("n", F.size("words")).where("n > 0")
    k = F.when(F.col("phrase"), F.col("n")).otherwise(F.least("n", F.lit(gram)))
    found = found.withColumn("k", k).withColumn("grams", F.col("n") - F.col("k") + 1)
    at = F.explode(F.sequence(F.lit(0), F.col("grams") - 1)).alias("at")
    return found.select("template", "label", "phrase", "words", "k", "grams", at).select(
        "template", "label", "phrase", "k", "grams", "at",
        F.array_join(F.slice("words", F.col("at") + 1, F.col("k")), " ").alias("gram"),
    )


def license_matches(
    documents: DataFrame,
    phrases: Sequence = PHRASES,
    notices: Sequence = NOTICES,
    gram: int = GRAM_WORDS,
    drift: int = DRIFT,
    gap: int = GAP_WORDS,
) -> DataFrame:
    """``k1, k2, label, phrase, start, coverage``: each place of a phrase, and each span with
    the part of its template's words that stand in it."""
    spark = documents.sparkSession
    templates = _templates(spark, phrases, notices, gram)
    plain = lambda text: len([w for w in _plain_words(text)])
    sizes = sorted({plain(t) for t, _ in phrases} | {min(gram, plain(t)) for _, t in notices})
    texts = with_words(documents, ascii_lower(F.col("text")), ITEM_SEPARATORS)
    placed = texts.select(*_ROW, "words", "n_words", F.posexplode("words").alias("pos", "_word"))
    hashes = [
        F.when(
            F.col("pos") + k <= F.col("n_words"),
            F.xxhash64(F.lit(k), *[F.get("words", F.col("pos") + i) for i in range(k)]),
        )
        for k in sizes
    ]
    rolling = placed.select(*_ROW, "words", "pos", F.explode(F.array(*hashes)).alias("hash"))
    known = templates.select("*", F.split("gram", " ").alias("w"))
    key = F.lit(None).cast("long")
    for k in sizes:
        own = F.xxhash64(F.lit(k), *[F.get("w", F.lit(i)) for i in range(k)])
        key = F.when(F.col("k") == k, own).otherwise(key)
    known = known.select(
        "template", "label", "phrase", "k", "grams", "at", "gram", key.alias("hash")
    )
    same = F.array_join(F.slice("words", F.col("pos") + 1, F.col("k")), " ") == F.col("gram")
    # The templates are constants of the program: a few hundred rows, whatever the input.
    votes = (
        rolling.join(F.broadcast(known), "hash")
        .where(same)
        .groupBy(*_ROW, "template", "label", "phrase", "grams", "k",
                 (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(F.collect_set("at").alias("voted"))
    )
    own = ["template", "label", "phrase", "grams", "k"]
    along = Window.partitionBy(*_ROW, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along)
    # A phrase is all there on its own diagonal: its places are never merged.
    opens = (F.col("phrase") | F.coalesce(apart > drift, F.lit(True))).cast("int")
    runs = votes.withColumn("opens", opens).withColumn("run", F.sum("opens").over(along))
    together = F.array_distinct(F.flatten(F.collect_list("voted"))).alias("voted")
    merged = runs.groupBy(*_ROW, *own, "run").agg(
        together,
        F.min(F.col("diagonal") + F.array_min("voted")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("voted") + F.col("k")).alias("end"),
    )
    # A run goes on where another of its template left off: further on in both texts. A run of
    # more than one place of the template overlaps what is before and begins a span of its own.
    by_place = Window.partitionBy(*_ROW, "template").orderBy("start", "run")
    before = lambda column: F.lag(column).over(by_place)
    follows = (
        ~F.col("phrase")
        & (F.col("start") - before(F.col("end")) <= gap)
        & (F.col("start") >= before(F.col("end")) - F.col("k"))
        & (F.array_min("voted") > before(F.array_max("voted")))
    )
    chained = merged.withColumn("opens", (~F.coalesce(follows, F.lit(False))).cast("int"))
    chained = chained.withColumn("span", F.sum("opens").over(by_place))
    spans = chained.groupBy(*_ROW, *own, "span").agg(together, F.min("start").alias("start"))
    # The words of the template that were compared and stand in the span.
    words = F.size(F.array_distinct(F.flatten(F.transform(
        "voted", lambda at: F.sequence(at, at + F.col("k") - 1)
    ))))
    coverage = words / (F.col("grams") + F.col("k") - 1)
    return spans.select(*_ROW, "label", "phrase", "start", coverage.alias("coverage"))


def _plain_words(text: str) -> list[str]:
    import re

    return [w for w in re.split(r"[^0-9A-Za-z]+", text) if w]


def scan_licenses(
    documents: DataFrame,
    phrases: Sequence = PHRASES,
    notices: Sequence = NOTICES,
    gram: int = GRAM_WORDS,
    drift: int = DRIFT,
    gap: int = GAP_WORDS,
    coverage: float = COVERAGE,
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` per row.

    The score is the largest part of any template's words found, 1 where a phrase stands. Null and
    empty texts have no words and no license; rows that repeat are each returned; columns but
    ``doc_id`` and ``text`` are ignored. Phrases and notices are ASCII text.
    """
    documents = documents.select("doc_id", "text")
    found = license_matches(documents, phrases, notices, gram, drift, gap)
    base = F.col("phrase")
    known = base | (F.col("coverage") >= coverage)
    per_row = found.groupBy(*_ROW).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.sort_array(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        F.sort_array(F.collect_set(F.when(known, F.col("label")))).alias("labels"),
        F.max("coverage").alias("score"),
    )
    counted = documents.select(
        "doc_id", *row_keys(),
        F.size(words_of(F.col("text"), ITEM_SEPARATORS_CASED)).cast("long").alias("n_words"),
    )
    none = F.array().cast("array<string>")
    return counted.join(per_row, list(_ROW), "left").select(
        "doc_id", "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"),
        F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
