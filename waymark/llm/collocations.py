"""Collocations: frequent phrases of two and three words, found level by level.

Words are counted first. Texts then become streams of codes of the frequent words; all else is
a break, since no phrase around it can be frequent. Candidates of a level are the phrases that
stand in the streams often enough and whose parts are frequent (Apriori). They are broadcast as
the next edges of a trie, in double arrays and in blocks of bounded size, of which a task holds
one at a time; the states of all places of a stream advance together, a word a level, and the
accepting states they end in are counted per task and summed up over tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.shared import UPPER, running_start, slices, stored, tidy

LEAST_COUNT = 10
LONGER_PERCENT = 50
BEST = 2_000
NO_LANGUAGE = "und"
# Words of one broadcast vocabulary, and phrases of one broadcast trie.
BLOCK_WORDS = 500_000
BLOCK_PHRASES = 500_000
# Bytes of text a task cuts into words together, codes it looks through together, and codes of
# a row of the stored streams; writers hold some hundred rows at a time.
SLICE_BYTES = 4_000_000
CHUNK_CODES = 1_000_000
ROW_CODES = 8_192
# Codes that are looked through together where tries are read block by block, and places that
# move on together.
SWEEP_CODES = 2_000_000
STEP_PLACES = 250_000
# Keys of a bucket, about, whose counts are summed up together.
BUCKET_KEYS = 500_000
# Parts of a language that are ranked by themselves first.
PARTS = 64
# Children of one base, and slots per child at first.
BASE_CHILDREN = 3
SLOTS = 2

_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
# Kinds of bytes: 0 belongs to a word, 1 parts words, 2 ends a piece.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[0x20, 0x09]] = 1
_KINDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
# Parts documents in a buffer of many; it ends a piece.
_BREAK = b"\n"


@dataclass
class Level:
    """Edges of a trie from the states of one level to those of the next, in a double array.

    A state has one base for each ``BASE_CHILDREN`` children or so, chosen by the symbol, and a
    child stands at base plus symbol, where ``parents`` and ``symbols`` check that it does.
    """

    firsts: np.ndarray
    bases: np.ndarray
    parents: np.ndarray
    symbols: np.ndarray
    states: np.ndarray

    @classmethod
    def build(cls, parents: np.ndarray, symbols: np.ndarray, n_parents: int) -> Level:
        """Of edges (state, symbol), each once; the state an edge leads to is its number."""
        children = np.bincount(parents, minlength=n_parents)
        firsts = np.concatenate([[0], np.cumsum(-(-children // BASE_CHILDREN))])
        base_of = firsts[parents] + symbols % np.maximum(np.diff(firsts)[parents], 1)
        order = np.argsort(base_of, kind="stable")
        groups, begins = np.unique(base_of[order], return_index=True)
        n_of = np.diff(np.append(begins, len(order)))
        size = SLOTS * len(parents) + 17
        rng = np.random.default_rng(size)
        while True:
            slots = cls._placed(symbols[order], groups, n_of, size, rng)
            if slots is not None:
                break
            size *= 2
        at, bases = slots
        own_bases = np.zeros(max(int(firsts[-1]), 1), np.int64)
        own_bases[groups] = bases
        made = cls(
            firsts.astype(np.int32), own_bases.astype(np.int32),
            *(np.full(size, -1, np.int32) for _ in range(3)),
        )
        made.parents[at], made.symbols[at], made.states[at] = parents[order], symbols[order], order
        return made

    @staticmethod
    def _placed(
        symbols: np.ndarray, groups: np.ndarray, n_of: np.ndarray, size: int,
        rng: np.random.Generator,
    ) -> tuple[np.ndarray, np.ndarray] | None:
        """A slot for each symbol and a base for each group of them, tried at random for all
        that have none yet; those that meet no other keep it. None if some never do."""
        taken = np.zeros(size, bool)
        bases = np.zeros(len(groups), np.int64)
        at = np.zeros(len(symbols), np.int64)
        group = np.repeat(np.arange(len(groups)), n_of)
        open_edges = np.arange(len(symbols))
        for _ in range(200):
            if not len(open_edges):
                return at, bases
            own = group[open_edges]
            here = np.unique(own)
            bases[here] = rng.integers(0, size, len(here))
            slot = (bases[own] + symbols[open_edges]) % size
            by_slot = np.argsort(slot, kind="stable")
            meets = np.zeros(len(slot), bool)
            same = slot[by_slot][1:] == slot[by_slot][:-1]
            meets[by_slot[1:][same]] = True
            meets |= taken[slot]
            failed = np.zeros(len(groups), bool)
            failed[own[meets]] = True
            placed = ~failed[own]
            at[open_edges[placed]] = slot[placed]
            taken[slot[placed]] = True
            open_edges = open_edges[~placed]
        return None

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states reached, −1 where there is no such edge."""
        first, end = self.firsts[states], self.firsts[states + 1]
        n = end - first
        base = self.bases[np.minimum(first + symbols % np.maximum(n, 1), len(self.bases) - 1)]
        slot = (base + symbols) % len(self.parents)
        found = (n > 0) & (self.parents[slot] == states) & (self.symbols[slot] == symbols)
        return np.where(found, self.states[slot], -1)


class Trie:
    """One level of candidates: the states before it, numbered from 1, a word's code, and the
    number of the phrase that both make."""

    def __init__(self, states: np.ndarray, codes: np.ndarray, numbers: np.ndarray):
        self._states, at = np.unique(states, return_inverse=True)
        self._level = Level.build(at, codes, len(self._states))
        self._numbers = numbers.astype(np.int32)

    def _after(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The numbers of the phrases that states and codes make, 0 where there is none."""
        own = np.minimum(np.searchsorted(self._states, states), len(self._states) - 1)
        known = np.flatnonzero(self._states[own] == states)
        edge = self._level.step(own[known], codes[known].astype(np.int64))
        found = np.zeros(len(states), np.int32)
        found[known[edge >= 0]] = self._numbers[edge[edge >= 0]]
        return found

    def move(
        self, after: np.ndarray, states: np.ndarray, codes: np.ndarray, nth: int, at: np.ndarray
    ) -> None:
        """Notes in ``after`` the states of the places ``at`` that have a phrase here."""
        for begin in range(0, len(at), STEP_PLACES):
            some = at[begin:begin + STEP_PLACES]
            found = self._after(states[some], codes[some + nth])
            after[some[found > 0]] = found[found > 0]

    def advance(self, states: np.ndarray, codes: np.ndarray, nth: int) -> np.ndarray:
        """The states after the word ``nth`` places on, 0 where there is no such phrase."""
        after = np.zeros(len(states), np.int32)
        self.move(after, states, codes, nth, np.flatnonzero(states[: max(len(states) - nth, 0)]))
        return after


def _let_go(shared: Broadcast) -> None:
    """Frees a task's copy of a broadcast value; it is read again from the executor's disk where
    it is wanted again. Workers live on, and would keep each value they have used."""
    if shared._path is not None:
        vars(shared).pop("_value", None)


@dataclass
class Edges:
    """One level of candidates in blocks: the least and greatest state before each, and its
    trie."""

    ends: list[tuple[int, int]]
    tries: list[Broadcast]

    def advance(self, states: np.ndarray, codes: np.ndarray, nth: int) -> np.ndarray:
        """As of one trie of all blocks. Of many, one at a time is in memory, and is asked for
        the places alone whose states it has."""
        if len(self.tries) == 1:
            return self.tries[0].value.advance(states, codes, nth)
        after = np.zeros(len(states), np.int32)
        at = np.flatnonzero(states[: max(len(states) - nth, 0)])
        at = at[np.argsort(states[at], kind="stable")]
        own = states[at]
        for (least, greatest), trie in zip(self.ends, self.tries):
            mine = at[np.searchsorted(own, least):np.searchsorted(own, greatest, "right")]
            if len(mine):
                trie.value.move(after, states, codes, nth, mine)
                _let_go(trie)
        return after


def _words(joined: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of a buffer of lowered text, and the number of the piece of each."""
    text = np.frombuffer(joined, np.uint8)
    kind = _KINDS[text]
    inside = kind == 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    offsets = pa.array(np.concatenate([[0], np.cumsum(ends - starts)]), pa.int64())
    words = pa.LargeStringArray.from_buffers(
        len(starts), offsets.buffers()[1], pa.py_buffer(text[inside].tobytes())
    )
    return words, np.cumsum(kind == 2)[starts]


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Lowered texts of a language, slice by slice, end to end."""
    for batch in batches:
        for some in slices(batch, SLICE_BYTES):
            languages = some.column(0).dictionary_encode()
            codes = languages.indices.to_numpy()
            texts = some.column(1).cast(pa.large_binary()).to_pylist()
            for n, language in enumerate(languages.dictionary.to_pylist()):
                own = [texts[row] or b"" for row in np.flatnonzero(codes == n)]
                yield language, (_BREAK.join(own) + _BREAK).translate(_LOWER)


def count_words(texts: DataFrame) -> DataFrame:
    """``lang, word, n`` of ``lang, text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for language, joined in _by_language(batches):
            words = _words(joined)[0].dictionary_encode()
            n = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(language, pa.string()), len(n)),
                 words.dictionary.cast(pa.string()), pa.array(n.astype(np.int64))],
                ["lang", "word", "n"],
            )

    found = texts.mapInArrow(tidy(count), "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _blocks(table: DataFrame, number: str, size: int) -> Iterator[DataFrame]:
    """The rows numbered from 1 in ``number``, in blocks of at most ``size``."""
    last = table.agg(F.max(number)).first()[0] or 0
    for begin in range(1, last + 1, size):
        yield table.where(F.col(number).between(begin, begin + size - 1))


def _numbered(table: DataFrame, order: list[str], name: str) -> DataFrame:
    """With ``name`` numbering the rows from 1, stored."""
    counted = running_start(table.withColumn("_one", F.lit(1)), [], order, "_one", "_ahead")
    return stored(
        counted.withColumn(name, (F.col("_ahead") + 1).cast("long")).drop("_one", "_ahead"),
        "numbered",
    )


def encode_streams(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``codes``: the texts as streams of 32-bit codes, stored. A 0 stands wherever two words
    are not in one piece, for words that are not in ``vocabulary`` (``lang, word, code``), and
    at the end of each row.

    The texts pass once, whatever the words; with more words than a block, a task holds one block
    at a time.
    """
    spark = texts.sparkSession
    blocks: list[tuple[frozenset[str], Broadcast]] = []
    for block in _blocks(vocabulary, "code", BLOCK_WORDS):
        # Bounded by the size of a block.
        table = block.select("lang", "word", "code").toArrow()
        own: dict[str, tuple[pa.Array, np.ndarray]] = {}
        languages = table["lang"].combine_chunks().dictionary_encode()
        for n, language in enumerate(languages.dictionary.to_pylist()):
            mine = table.filter(pa.array(languages.indices.to_numpy() == n))
            own[language] = (
                mine["word"].combine_chunks().cast(pa.large_string()),
                mine["code"].to_numpy().astype("<i4"),
            )
        blocks.append((frozenset(own), spark.sparkContext.broadcast(own)))
    if not blocks:
        return spark.createDataFrame([], "codes binary")
    rows = stored(texts.mapInArrow(tidy(_filler(blocks)), "codes binary"), "streams")
    for _, words in blocks:
        words.unpersist()
    return rows


def _filler(blocks: Sequence[tuple[frozenset[str], Broadcast]]) -> Callable:
    """Turns ``lang, text`` into rows of ``codes``, by blocks of words and the languages of
    each."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for language, joined in _by_language(batches):
            own, pieces = _words(joined)
            own = own.dictionary_encode()
            code_of = np.zeros(len(own.dictionary), "<i4")
            for languages, words in blocks:
                if language not in languages:
                    continue
                known, numbers = words.value[language]
                at = pc.index_in(own.dictionary, value_set=known)
                met = pc.is_valid(at).to_numpy(zero_copy_only=False)
                code_of[met] = numbers[at.drop_null().to_numpy()]
                if len(blocks) > 1:
                    del known, numbers
                    _let_go(words)
            yield from _rows(_stream(code_of[own.indices.to_numpy()], pieces))
        for _, words in blocks:
            _let_go(words)

    return fill


def _stream(codes: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """Codes of words with a 0 between pieces and at the end; of zeros side by side one stays."""
    broken = np.flatnonzero(np.diff(pieces)) + 1
    own = np.append(np.insert(codes, broken, 0), 0).astype("<i4")
    return own[(own != 0) | (np.append(1, own[:-1]) != 0)]


def _rows(codes: np.ndarray, *beside: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A stream in rows of some ``ROW_CODES`` codes, each ending in a 0, with what stands beside
    the codes."""
    ends = np.flatnonzero(codes == 0) + 1
    begin = 0
    while begin < len(codes):
        at = np.searchsorted(ends, begin + ROW_CODES)
        end = int(ends[at]) if at < len(ends) else len(codes)
        yield pa.RecordBatch.from_arrays(
            [pa.array([c[begin:end].tobytes()], pa.binary()) for c in (codes, *beside)],
            ["codes", "states"][: 1 + len(beside)],
        )
        begin = end


def _chunks(batches: Iterator[pa.RecordBatch], n_codes: int) -> Iterator[list[np.ndarray]]:
    """Rows end to end, some ``n_codes`` codes at a time: the codes, and what stands beside
    them."""
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        for row in zip(*batch.columns):
            held.append([np.frombuffer(c.as_buffer(), "<i4") for c in row])
            size += len(held[-1][0])
            if size >= n_codes:
                yield [np.concatenate(c) for c in zip(*held)]
                held, size = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


@dataclass
class Streams:
    """Streams with the states their places are in: the codes, or ``states`` if there is such a
    column, moved on by ``edges``, one for each level since."""

    rows: DataFrame
    level: int = 1
    edges: tuple[Edges, ...] = ()

    def reader(self) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]:
        """What gives a task the codes and states of its chunks."""
        first, edges = self.level - len(self.edges), self.edges
        many = any(len(e.tries) > 1 for e in edges)
        n_codes = SWEEP_CODES if many else CHUNK_CODES

        def states(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for codes, *beside in _chunks(batches, n_codes):
                own = beside[0] if beside else codes
                for n, level in enumerate(edges):
                    own = level.advance(own, codes, first + n)
                yield codes, own
            for level in edges:
                for trie in level.tries:
                    _let_go(trie)

        return states

    def done(self) -> None:
        """Takes the tries back from the executors."""
        for level in self.edges:
            for trie in level.tries:
                trie.unpersist()


def _summed(
    rows: DataFrame, keyed: Callable[[Iterator[pa.RecordBatch]], Iterator], least: int, places: int
) -> DataFrame:
    """``key, n``: the counts of keys, summed over tasks, of at least ``least``.

    Tasks give sorted keys with their counts (``keyed``). These are packed by buckets of keys,
    as many as leave ``BUCKET_KEYS`` keys to each, and a bucket's packs are summed as they come.
    """
    n_buckets = places // BUCKET_KEYS + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in keyed(batches):
            # Keys that follow each other belong to different buckets.
            mixed = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            bucket = (mixed % np.uint64(n_buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            buckets, begins = np.unique(bucket[order], return_index=True)
            ends = np.append(begins[1:], len(order))
            packs = [
                [c[order[a:b]].astype(np.int64).tobytes() for a, b in zip(begins, ends)]
                for c in (keys, counts)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.int32()), *[pa.array(p, pa.binary()) for p in packs]],
                ["bucket", "keys", "counts"],
            )

    def merge(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, np.concatenate([c for _, c in held]))
        return keys, total

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, size = None, [], 0

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                keys, total = merge(held)
                often = total >= least
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[often]), pa.array(total[often])], ["key", "n"]
                )

        for batch in batches:
            for own, *packs in zip(*batch.columns):
                if own.as_py() != bucket:
                    yield from done()
                    bucket, held, size = own.as_py(), [], 0
                keys, counts = (np.frombuffer(p.as_buffer(), "<i8") for p in packs)
                held.append((keys, counts))
                size += len(keys)
                if size > 4 * BUCKET_KEYS:
                    held = [merge(held)]
                    size = len(held[0][0])
        yield from done()

    packed = rows.mapInArrow(tidy(pack), "bucket int, keys binary, counts binary")
    ordered = packed.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(tidy(add), "key long, n long")


def _next_phrases(streams: Streams, least: int, places: int) -> DataFrame:
    """``state, code, number``: phrases a word longer than the streams' states, that stand
    ``least`` times where the phrase from the next word on has a state as well; stored."""
    level, read = streams.level, streams.reader()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for codes, states in read(batches):
            n = max(len(codes) - level, 0)
            safe = np.flatnonzero((states[:n] > 0) & (states[1 : n + 1] > 0))
            keys = states[safe].astype(np.int64) * 2**32 + codes[safe + level]
            yield np.unique(keys, return_counts=True)

    met = stored(_summed(streams.rows, keyed, least, places).select("key"), "phrases")
    numbered = _numbered(met, ["key"], "number")
    low = F.lit(2**32 - 1).cast("long")
    return numbered.select(
        F.shiftright("key", 32).alias("state"), F.col("key").bitwiseAND(low).alias("code"), "number"
    )


def _advanced(streams: Streams, phrases: DataFrame, again: bool = False) -> Streams:
    """The streams a level on, by tries of blocks of phrases that tasks apply as they go. Of more
    than one block the states are found once and stored, if they are to be used ``again``."""
    spark = phrases.sparkSession
    edges = Edges([], [])
    for block in _blocks(phrases, "number", BLOCK_PHRASES):
        # Bounded by the size of a block.
        table = block.select("state", "code", "number").toArrow()
        states, codes, numbers = (table[c].to_numpy() for c in table.column_names)
        edges.ends.append((int(states.min()), int(states.max())))
        edges.tries.append(spark.sparkContext.broadcast(Trie(states, codes, numbers)))
    moved = Streams(streams.rows, streams.level + 1, (*streams.edges, edges))
    if len(edges.tries) == 1 or not again:
        return moved
    read = moved.reader()

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, states in read(batches):
            yield from _rows(codes, states)

    out = "codes binary, states binary"
    rows = stored(streams.rows.mapInArrow(tidy(move), out), "states")
    moved.done()
    return Streams(rows, moved.level)


def _tallied(chunks: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers over 0 and how often each stands. Those of one block of phrases are counted in a
    table for all chunks, those of many chunk by chunk: a table of all would grow with them."""
    total = np.zeros(0, np.int64)
    for numbers in chunks:
        numbers = numbers[numbers > 0]
        if len(numbers) and numbers.max() > BLOCK_PHRASES:
            yield np.unique(numbers, return_counts=True)
            continue
        accepted = np.bincount(numbers)
        if len(accepted) > len(total):
            total = np.pad(total, (0, len(accepted) - len(total)))
        total[: len(accepted)] += accepted
    met = np.flatnonzero(total)
    yield met, total[met]


def _counted(streams: Streams, places: int) -> DataFrame:
    """``number, n``: how often each phrase stands in the streams, stored."""
    read = streams.reader()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield from _tallied(states for _, states in read(batches))

    found = _summed(streams.rows, keyed, 1, places)
    return stored(found.select(F.col("key").alias("number"), "n"), "counts")


def _score(a: str, parts: list[Column]) -> Column:
    """floor(1000000 a² / (l r)) in whole numbers of up to 38 digits."""
    whole = lambda c: c.cast("decimal(16,0)")
    product = whole(parts[0]) * whole(parts[1])
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (
        (whole(F.col(a)) * whole(F.col(a))).cast("decimal(31,0)")
    ), product)


_OUT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


def collocations(
    documents: DataFrame,
    least_count: int = LEAST_COUNT,
    longer_percent: int = LONGER_PERCENT,
    best: int = BEST,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``best`` phrases of each language.

    Texts are lowered (A-Z), cut into pieces at marks and line ends, and pieces into words at
    spaces and tabs; a phrase stands within a piece. A phrase of two or three words is a
    candidate if it stands ``least_count`` times (``a``). Its score is the least, over its cuts
    in two, of floor(1000000 a² / (l r)), ``l`` and ``r`` being the counts of the two parts,
    with the earliest of equal cuts. Candidates inside a longer one that stands at least
    ``longer_percent`` percent as often are left out. ``n`` is the number of words of the
    language; null languages are ``und``, null texts empty. Phrases go by score, then count,
    both falling, then by their bytes. An empty table gives no rows; ids and other columns are
    ignored, and repeated rows count as often as they stand.
    """
    texts = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), "text"
    )
    words = stored(count_words(texts), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = words.where(F.col("n") >= least_count)
    vocabulary = _numbered(frequent, ["lang", "word"], "code")
    streams = encode_streams(texts, vocabulary)

    places = streams.agg(F.sum(F.length("codes"))).first()[0] or 0
    places = places // 4
    one = Streams(streams)
    pairs = _next_phrases(one, least_count, places)
    if pairs.isEmpty():
        return documents.sparkSession.createDataFrame([], _OUT)
    two_words = _advanced(one, pairs, again=True)
    two = pairs.select(F.col("state").alias("c1"), F.col("code").alias("c2"), "number").join(
        _counted(two_words, places), "number"
    )
    triples = _next_phrases(two_words, least_count, places)
    if triples.isEmpty():
        three = two.select("c1", "c2", F.col("c2").alias("c3"), "n").limit(0)
    else:
        three_words = _advanced(two_words, triples)
        three = triples.join(_counted(three_words, places), "number").select(
            F.col("state").alias("number"), F.col("code").alias("c3"), "n"
        ).join(two.select("number", "c1", "c2"), "number").select("c1", "c2", "c3", "n")
        three_words.done()
    two_words.done()
    two = stored(two.drop("number"), "pairs")
    three = stored(three, "triples")

    word = lambda c, n: vocabulary.select(F.col("code").alias(c), F.col("n").alias(n))
    pair = lambda a, b, n: two.select(F.col("c1").alias(a), F.col("c2").alias(b), F.col("n").alias(n))
    part = lambda l, r, k: F.struct(
        _score("a", [F.col(l), F.col(r)]).alias("score"), F.lit(k).alias("k"),
        F.col(l).alias("l"), F.col(r).alias("r"),
    )
    # The phrase itself, and how often the longest phrase around it stands.
    around = three.select("c1", "c2", "n").unionByName(
        three.select(F.col("c2").alias("c1"), F.col("c3").alias("c2"), "n")
    ).groupBy("c1", "c2").agg(F.max("n").alias("_longer"))
    twos = two.withColumnRenamed("n", "a").join(around, ["c1", "c2"], "left").where(
        F.col("_longer").isNull() | (100 * F.col("_longer") < longer_percent * F.col("a"))
    ).join(word("c1", "l1"), "c1").join(word("c2", "r1"), "c2").select(
        "c1", "c2", F.lit(None).cast("long").alias("c3"), "a", part("l1", "r1", 1).alias("cut")
    )
    threes = three.withColumnRenamed("n", "a").join(word("c1", "l1"), "c1").join(
        pair("c2", "c3", "r1"), ["c2", "c3"]
    ).join(pair("c1", "c2", "l2"), ["c1", "c2"]).join(word("c3", "r2"), "c3").select(
        "c1", "c2", "c3", "a", F.least(part("l1", "r1", 1), part("l2", "r2", 2)).alias("cut")
    )
    named = lambda n: vocabulary.select(
        F.col("code").alias(f"c{n}"), F.col("word").alias(f"w{n}"), *(["lang"] if n == 1 else [])
    )
    found = twos.unionByName(threes)
    for n in (1, 2):
        found = found.join(named(n), f"c{n}")
    found = found.join(named(3), "c3", "left").select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "cut.l", "cut.r",
        "cut.score",
    )
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # The best of each part of a language, and of these the best of all.
    part_of = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    nth = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    some = found.withColumn("part", part_of).withColumn("nth", nth).where(F.col("nth") <= best)
    ranked = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    first = some.withColumn("rank", ranked).where(F.col("rank") <= best)
    return first.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
        F.col("total").alias("n"), F.col("score").cast("long").alias("score"),
    )
