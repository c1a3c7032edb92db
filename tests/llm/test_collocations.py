import random
import re
from collections import Counter, defaultdict

import numpy as np
import plain
import pytest

from waymark.llm import collocations as module
from waymark.llm.collocations import Edges, Trie, collocations
from waymark.llm.registry import op13_collocations


def expected(rows, least=10, percent=50, best=2000):
    """From the definition: every phrase of one to three words counted in a table."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", (text or "").translate(plain.LOWER)):
            words = [w for w in re.split("[\\x20\\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(zip(*(words[n:] for n in range(k))))
    found = []
    for lang, of in counts.items():
        kept = {p: a for p, a in of.items() if len(p) > 1 and a >= least}
        inside = {q for p, a in kept.items() if len(p) == 3
                  for q in (p[:2], p[1:]) if 100 * a >= percent * of[q]}
        scored = []
        for p, a in kept.items():
            if p in inside:
                continue
            cuts = [(1_000_000 * a * a // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]]))
        found += [(lang, n, p.decode(), -a, l, r, totals[lang], -s)
                  for n, (s, a, p, l, r) in enumerate(sorted(scored)[:best], 1)]
    return sorted(found)


def found(frame):
    assert frame.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in frame.collect())


def given(frame):
    return [(r.lang, r.text) for r in frame.select("lang", "text").collect()]


def test_registered_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = given(spark.read.parquet(f"{sf}/documents.parquet"))
    assert found(op13_collocations(spark, sf)) == expected(rows)


@pytest.mark.parametrize("blocks", ["one", "many"])
def test_equals_plain_version(spark, monkeypatch, blocks):
    if blocks == "many":
        monkeypatch.setattr(module, "BLOCK_WORDS", 3)
        monkeypatch.setattr(module, "BLOCK_PHRASES", 5)
        monkeypatch.setattr(module, "ROW_CODES", 7)
        monkeypatch.setattr(module, "CHUNK_CODES", 20)
        monkeypatch.setattr(module, "SLICE_BYTES", 300)
        monkeypatch.setattr(module, "BUCKET_KEYS", 9)
    dice = random.Random(9)
    words = ["the", "The", "red", "Köln", " x", "of", "漢字", "a\x00b", "it's", "rare-%d"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!"]
    def text():
        return "".join(
            (w % dice.randrange(999) if "%" in w else w) + dice.choice(marks)
            for w in dice.choices(words, [9, 3, 4, 3, 2, 5, 2, 2, 1, 6], k=dice.randrange(60)))
    rows = [(n, text(), dice.choice(["en", "en", "de", None, "und"]), None, None)
            for n in range(60)]
    rows += [(70, "red the red the red " * 40, "en", None, None)] * 3
    rows += [(None, None, None, None, None), (71, "", "fr", None, None), (72, "...", "xx", None, None)]
    docs = plain.documents(spark, rows).repartition(4)
    assert found(collocations(docs, best=12)) == expected(given(docs), best=12)


def test_nothing_frequent_and_empty(spark):
    assert collocations(plain.empty(spark)).collect() == []
    assert collocations(plain.documents(spark)).collect() == []
    # Frequent words without a frequent phrase.
    rows = [(n, "one. two. three", "en", None, None) for n in range(20)]
    assert collocations(plain.documents(spark, rows)).collect() == []


def test_trie_accepts_its_phrases_only():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 40, 20_000).astype("<i4")
    edges = np.unique(rng.integers(1, 40, (900, 2)), axis=0)
    # One state with very many children.
    edges = np.unique(np.vstack([edges, [(7, c) for c in range(1, 5000)]]), axis=0)
    numbers = rng.permutation(len(edges)) + 1
    states = rng.integers(0, 45, len(codes))
    after = Trie(edges[:, 0], edges[:, 1], numbers).advance(states, codes, 2)
    known = {tuple(e): n for e, n in zip(edges.tolist(), numbers.tolist())}
    wanted = [known.get((s, c), 0) for s, c in zip(states.tolist(), codes[2:].tolist())]
    assert after.tolist() == wanted + [0, 0]


def test_many_blocks_pass_texts_and_streams_once(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_WORDS", 2)
    monkeypatch.setattr(module, "BLOCK_PHRASES", 3)
    names, stored = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, name: names.append(name) or stored(df, name))
    dice = random.Random(4)
    rows = [(n, " ".join(dice.choices("abcdef", [6, 5, 4, 3, 2, 1], k=40)), "en", None, None)
            for n in range(40)]
    docs = plain.documents(spark, rows).repartition(3)
    assert found(collocations(docs)) == expected(given(docs))
    # Once, not once for each block of words or phrases.
    assert names.count("streams") == 1 and names.count("states") == 1


def test_blocks_of_tries_are_one_trie_and_one_at_a_time_in_memory():
    class Shared:
        """A broadcast variable as a task has it."""

        _path = "somewhere"

        def __init__(self, made):
            self.made = made

        @property
        def value(self):
            assert not [s for s in every if s is not self and hasattr(s, "_value")]
            self._value = self.made
            return self._value

    rng = np.random.default_rng(5)
    edges = np.unique(rng.integers(1, 60, (2_000, 2)), axis=0)
    numbers = np.arange(1, len(edges) + 1)
    cuts = [slice(n, n + 100) for n in range(0, len(edges), 100)]
    every = [Shared(Trie(edges[c, 0], edges[c, 1], numbers[c])) for c in cuts]
    ends = [(int(edges[c, 0].min()), int(edges[c, 0].max())) for c in cuts]
    states = rng.integers(0, 70, 5_000).astype("<i4")
    codes = rng.integers(0, 70, 5_000).astype("<i4")
    whole = Trie(edges[:, 0], edges[:, 1], numbers).advance(states, codes, 1)
    assert Edges(ends, every).advance(states, codes, 1).tolist() == whole.tolist()
    assert (whole > 0).any() and not [s for s in every if hasattr(s, "_value")]


def test_counts_of_many_blocks_need_no_table_of_all_numbers():
    large = 2**31 - 2
    chunks = [np.array(c, "<i4") for c in ([0, 3, 3, 5], [large, 0, 3, large], [5, 0], [0])]
    total = Counter()
    for numbers, counts in module._tallied(iter(chunks)):
        total.update(dict(zip(numbers.tolist(), counts.tolist())))
    assert total == {3: 3, 5: 2, large: 2}
