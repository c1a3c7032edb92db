"""Language identification by cross-parsing entropy.

Each language has a reference text. A document is parsed against it into phrases, each the
longest run of what is left that occurs anywhere in the reference, found with the reference's
suffix automaton. A text needs few phrases against its own language. The count, times the
bits that name a place in the reference and per byte of the document, estimates the entropy
of the document relative to the language; the least wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from waymark.llm.shared import quoted, running_start, slices, stored, text_sample, tidy

UNDETERMINED = "und"
# The sample a language is learnt from: so many bytes of reference, out of pieces of so many
# documents at most, no piece longer than this.
REFERENCE_BYTES = 24_000
SAMPLE_DOCUMENTS = 96
SAMPLE_CHARS = 4_000
# Every language has a table in memory; of more than this, one block is held after another.
BLOCK_LANGUAGES = 32
# Bytes of text that are parsed together.
SLICE_BYTES = 8_000_000
# With fewer texts than this left, each is parsed on its own.
LANES = 24


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


@F.pandas_udf(BooleanType())
def holds_letter(text: pd.Series) -> pd.Series:
    """Whether a text holds a letter, as the parser sees it; false for null."""
    return text.map(has_letter).astype(bool)


def letters_only(text: str) -> bytes:
    """UTF-8 of the text in lower case, all ASCII but its letters as spaces."""
    return text.lower().encode().translate(_PLAIN)


_PLAIN = bytes(
    b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def suffix_automaton(text: bytes) -> tuple[list[dict[int, int]], int]:
    """Transitions of the least automaton that reads every run of ``text``; state 0 starts."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in text:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = state
            at = link[at]
        if at >= 0:
            to = moves[at][symbol]
            if length[to] == length[at] + 1:
                link[state] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                link[to] = link[state] = copy
                while at >= 0 and moves[at].get(symbol) == to:
                    moves[at][symbol] = copy
                    at = link[at]
        last = state
    return moves, len(moves)


class CrossParser:
    """Counts the phrases of texts against the references of several languages.

    The automata are laid out as one table over states and kinds of bytes. An entry holds
    where the byte leads and how many phrases it ends: none while a run goes on; one when it
    breaks and the byte starts the next; one more if the reference lacks the byte altogether.
    """

    def __init__(self, references: dict[str, bytes]):
        self.languages = sorted(references)
        self.bits = [np.log2(max(2, len(references[l]))) for l in self.languages]
        seen = sorted(set(b"".join(references.values())))
        self.kinds = np.full(256, len(seen), np.uint8)
        self.kinds[seen] = np.arange(len(seen))
        width = len(seen) + 1
        tables, self.roots, base = [], [], 0
        for language in self.languages:
            moves, states = suffix_automaton(references[language])
            first = np.full(width, -1, np.int64)
            for symbol, to in moves[0].items():
                first[self.kinds[symbol]] = to
            restart = np.where(first >= 0, first, 0)
            # Leaving a run ends it; a byte the reference lacks is a phrase of its own.
            table = np.tile((base + restart * width) * 4 + 1 + (first < 0), (states, 1))
            table[0] = (base + restart * width) * 4 + (first < 0)
            for state, own in enumerate(moves):
                for symbol, to in own.items():
                    table[state, self.kinds[symbol]] = (base + to * width) * 4
            tables.append(table.reshape(-1))
            self.roots.append(base)
            base += states * width
        self.table = np.concatenate([*tables, np.zeros(0, np.int64)]).astype(np.int32 if base < 2**28 else np.int64)

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text against each language (texts × languages)."""
        counts = np.zeros((len(texts), len(self.languages)), np.int64)
        order = sorted(range(len(texts)), key=lambda n: -len(texts[n]))
        lengths = np.array([len(texts[n]) for n in order])
        flat = self.kinds[np.frombuffer(b"".join(texts[n] for n in order), np.uint8)]
        begins = np.cumsum(lengths) - lengths
        roots = np.array(self.roots, self.table.dtype)
        state = np.repeat(roots[:, None], len(texts), axis=1)
        count = np.zeros(state.shape, np.int64)
        at, longest = 0, int(lengths[0]) if len(texts) else 0
        # All texts go forward together, a byte at a time; the shorter ones end first.
        ends = np.searchsorted(-lengths, -np.arange(longest + 1), side="left")
        while at < longest and ends[at] >= LANES:
            n = int(ends[at])
            step = self.table[state[:, :n] + flat[begins[:n] + at]]
            state[:, :n] = step >> 2
            count[:, :n] += step & 3
            at += 1
        table = memoryview(self.table)
        for lane in range(int(ends[at]) if at < longest else 0):
            rest = flat[begins[lane] + at : begins[lane] + lengths[lane]].tobytes()
            for row in range(len(roots)):
                now, more = int(state[row, lane]), 0
                for kind in rest:
                    step = table[now + kind]
                    now = step >> 2
                    more += step & 3
                state[row, lane] = now
                count[row, lane] += more
        count += state != roots[:, None]
        counts[order] = count.T
        return counts

    def leaders(self, texts: list[str | None]) -> Leaders:
        """The cheapest language of each text with a letter, and the two least costs."""
        found: Leaders = [None] * len(texts)
        wanted = [n for n, t in enumerate(texts) if has_letter(t) and self.languages]
        if not wanted:
            return found
        cost = self.phrases([letters_only(texts[n]) for n in wanted]) * np.array(self.bits)
        best = cost.argmin(axis=1)
        ranked = np.sort(cost, axis=1)
        second = ranked[:, 1] if cost.shape[1] > 1 else np.full(len(wanted), np.inf)
        for n, language, *costs in zip(wanted, best.tolist(), ranked[:, 0].tolist(), second.tolist()):
            found[n] = (self.languages[language], *costs)
        return found

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language of each text and how far the runner-up is behind, from 0 to 1."""
        return scored(self.leaders(texts))


# Per text the cheapest language, its cost and the runner-up's; none without a letter.
Leaders = list[tuple[str, float, float] | None]


def merged(before: Leaders, after: Leaders) -> Leaders:
    """The leaders among the languages of both; equal costs go to ``before``."""
    found: Leaders = []
    for a, b in zip(before, after):
        if a is None or b is None:
            found.append(a or b)
        else:
            first, other = (b, a) if b[1] < a[1] else (a, b)
            found.append((first[0], first[1], min(first[2], other[1])))
    return found


def scored(leaders: Leaders) -> list[tuple[str, float]]:
    """Languages and scores; a sole language counts as if the next one cost twice as much."""
    found = []
    for leader in leaders:
        if leader is None:
            found.append((UNDETERMINED, 0.0))
            continue
        language, least, second = leader
        lead = 1 - least / max(2 * least if second == np.inf else second, 1e-9)
        found.append((language, min(1.0, max(0.0, lead))))
    return found


def fold(doc_id: Column) -> Column:
    """The fold of a document; those of fold 0 are held out, a null id is in none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def reference_table(
    labelled: DataFrame,
    reference_bytes: int = REFERENCE_BYTES,
    sample_documents: int = SAMPLE_DOCUMENTS,
    sample_chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """``lang, text, number``: a reference text per language of ``labelled`` (``text, lang``), out
    of a bounded sample, the languages numbered from 0 by code point; stored.

    Every labelled text gives a piece, from its first letter on and of at most ``sample_chars``
    characters. Of a language's distinct pieces, those first by hash are joined until the
    reference is full. Rows without a label or a letter teach nothing. A language with less
    text has a shorter reference.
    """
    piece = F.regexp_extract("text", rf"(?s)\p{{L}}.{{0,{sample_chars - 1}}}", 0)
    pieces = labelled.select("lang", piece.alias("text"))
    usable = F.col("lang").isNotNull() & (F.length("text") > 0)
    sample = text_sample(pieces, usable, sample_documents, ["lang"])
    # Bounded: so many distinct pieces of a language, none long.
    joined = F.array_join(F.sort_array(F.collect_list(F.struct("mark", "text")))["text"], " ")
    # A character has a byte at least, so the reference lies within so many of them.
    languages = sample.groupBy("lang").agg(F.substring(joined, 1, reference_bytes).alias("text"))
    numbered = running_start(
        languages.withColumns({"one": F.lit(1), "most": F.lit(reference_bytes)}), [], ["lang"],
        "one", "number",
    )
    return stored(numbered.select("lang", "text", "number", "most"), "references")


def _references(rows: DataFrame) -> dict[str, bytes]:
    return {r["lang"]: letters_only(r["text"])[: r["most"]] for r in rows.collect()}


def learn_references(labelled: DataFrame, **settings) -> dict[str, bytes]:
    """The references of ``reference_table`` on the driver, for a number of languages known to
    be small."""
    return _references(reference_table(labelled, **settings))


_PARSERS: dict[int, CrossParser] = {}


def _parser(references: dict[str, bytes]) -> CrossParser:
    """The worker's own parser; it is built once from the references and kept."""
    key = hash(tuple(sorted(references.items())))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = CrossParser(references)
    return _PARSERS[key]


def judge_languages(
    documents: DataFrame, references: DataFrame | dict[str, bytes]
) -> DataFrame:
    """``identify_languages`` with one more column ``determined``: false for null texts and those
    without a letter, and for all if no language was learnt, whatever languages are called."""
    added = ("lang_pred", "score", "determined")
    columns = [c for c in documents.columns if c not in added]
    at = columns.index("text")
    if isinstance(references, dict):
        languages = sorted(references)
        n_languages = len(languages)
        blocks = (
            {l: references[l] for l in languages[n : n + BLOCK_LANGUAGES]}
            for n in range(0, n_languages, BLOCK_LANGUAGES)
        )
    else:
        n_languages = references.count()
        # Bounded by the size of a block.
        blocks = (
            _references(references.where(F.col("number").between(n, n + BLOCK_LANGUAGES - 1)))
            for n in range(0, n_languages, BLOCK_LANGUAGES)
        )
    rows = documents.select(*quoted(columns))
    given = ", ".join(
        f"`{c.replace('`', '``')}` {documents.schema[c].dataType.simpleString()}" for c in columns
    )
    leader = "leader"
    while leader in columns:
        leader += "_"
    n_blocks = max(1, -(-n_languages // BLOCK_LANGUAGES))
    for n, block in enumerate(blocks if n_languages else [{}]):
        last = n + 1 == n_blocks

        def parse(
            batches: Iterator[pa.RecordBatch], block=block, n=n, last=last
        ) -> Iterator[pa.RecordBatch]:
            parser = _parser(block)
            for batch in (some for b in batches for some in slices(b, SLICE_BYTES, at)):
                found = parser.leaders(batch.column(at).to_pylist())
                kept = batch.columns[: len(columns)]
                if n:
                    before = [
                        l and (l["language"], l["least"], l["second"])
                        for l in batch.column(len(columns)).to_pylist()
                    ]
                    found = merged(before, found)
                if last:
                    named = scored(found)
                    more = [
                        pa.array([f[0] for f in named], pa.string()),
                        pa.array([f[1] for f in named], pa.float64()),
                        pa.array([f is not None for f in found], pa.bool_()),
                    ]
                    yield pa.RecordBatch.from_arrays([*kept, *more], [*columns, *added])
                else:
                    made = [f and dict(zip(("language", "least", "second"), f)) for f in found]
                    yield pa.RecordBatch.from_arrays(
                        [*kept, pa.array(made, _LEADER)], [*columns, leader]
                    )

        if last:
            return rows.mapInArrow(tidy(parse), f"{given}, lang_pred string, score double, determined boolean"
            )
        rows = stored(rows.mapInArrow(tidy(parse), f"{given}, `{leader}` struct<language:string,least:double,second:double>"
        ), "leaders")


_LEADER = pa.struct([
    ("language", pa.string()), ("least", pa.float64()), ("second", pa.float64())
])


def identify_languages(
    documents: DataFrame, references: DataFrame | dict[str, bytes]
) -> DataFrame:
    """All columns of ``documents`` with ``lang_pred`` and ``score`` added, from its text alone.

    Every whole text is parsed against every language (``reference_table``, or a dictionary of
    few). With more than ``BLOCK_LANGUAGES`` the rows pass once per block of languages, with the
    leader so far beside them. Null texts and those without a letter are ``und`` with score 0,
    as is everything if no language was learnt; equal costs go to the first language by code
    point. Columns named like those added are replaced.
    """
    return judge_languages(documents, references).drop("determined")
