"""Secret scans: fixed patterns, and character Markov models compared by likelihood.

Two models of characters following one another are trained, one from strings that a pattern
has labelled as secrets, one from the other identifiers beside them. A token is a secret by
the models if it is likelier a random string by so many nats in all, whatever characters it is
made of, and by so many per character, so that length alone does not make one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.shared import slices, stored, text_sample, tidy

# Kinds in order, their patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_CHARS = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_CHARS = 18
# A run of at least the least length is the same as a run held to it afterwards.
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")

# What the models judge: runs of the characters keys are written in, as long as a base value.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
TOKEN_CHARS = 12
IDENTIFIER = re.compile(r"[A-Za-z0-9+/_=-]{6,}")

# The sample the models are trained on: so many documents that hold a labelled secret, of
# longer ones a window of this many characters round it.
SAMPLE_DOCUMENTS = 2_000
SAMPLE_CHARS = 20_000
# Least likelihood ratio of a token, in nats, and per character.
THRESHOLD = 6.0
LEAST_MEAN = 0.15
# Bytes of text that are judged together.
SLICE_BYTES = 2_000_000

# Characters as the models see them: 64 that keys are written in, the start, and all others.
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_OTHER = len(_ALPHABET)
_START = _OTHER + 1
_SYMBOLS = _OTHER + 2
_CODES = {c: n for n, c in enumerate(_ALPHABET)}
_BYTE_CODES = np.full(256, _OTHER)
_BYTE_CODES[list(_ALPHABET.encode())] = np.arange(_OTHER)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of what the patterns find, kinds by number."""
    found = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= ASSIGN_CHARS
    ]
    found += [
        (m.start(), 1, m.end()) for m in ACCESS.finditer(text)
        if m.end() - m.start() >= ACCESS_CHARS
    ]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def labelled_value(text: Column) -> Column:
    """The first place of ``text`` that the patterns label, as a string; null without one.

    The same patterns as in ``base_spans``, one kind after the other; what must stand in a text
    for any of them is looked for first.
    """
    assign = F.lit(f"(?i){ASSIGN.pattern}")
    places = F.arrays_zip(
        F.regexp_extract_all(text, assign, F.lit(0)).alias("place"),
        F.regexp_extract_all(text, assign, F.lit(2)).alias("value"),
    )
    long = F.filter(places, lambda p: F.length(p["value"]) >= ASSIGN_CHARS)
    access = rf"AKIA[A-Z0-9]{{{ACCESS_CHARS - 4},}}"
    hints = r"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{16}"
    return F.when(text.rlike(hints), F.coalesce(
        F.get(long, F.lit(0))["place"],
        *[F.nullif(F.regexp_extract(text, p, 0), F.lit("")) for p in (access, HEX.pattern)],
    ))


def training_text(text: Column, chars: int) -> Column:
    """A text with a labelled value, of a longer one than ``chars`` the window round the first;
    null without one."""
    value = labelled_value(text)
    # The window ends with the text where that comes first.
    begin = F.greatest(
        F.least(F.instr(text, value) - chars // 2, F.length(text) - chars + 1), F.lit(1)
    )
    window = F.substring(text, begin, F.lit(chars))
    return F.when(value.isNotNull(), F.when(F.length(text) <= chars, text).otherwise(window))


def _codes(token: str) -> list[int]:
    return [_START, *(_CODES.get(c, _OTHER) for c in token)]


class MarkovRatio:
    """The two models, as one table of log-likelihood ratios of character pairs."""

    def __init__(self, secrets: np.ndarray, ordinary: np.ndarray):
        # One of each pair is taken as seen, so that no pair is impossible.
        logs = [
            np.log((seen + 1.0) / (seen + 1.0).sum(axis=1, keepdims=True))
            for seen in (secrets, ordinary)
        ]
        self.ratio = logs[0] - logs[1]

    def score(self, token: str) -> float:
        """Nats by which the token is likelier a secret."""
        codes = _codes(token)
        return float(self.ratio[codes[:-1], codes[1:]].sum())

    def tokens(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and score of every token of UTF-8 text, all at once."""
        codes = _BYTE_CODES[np.frombuffer(text, np.uint8)]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], codes < _OTHER, [False]])))
        begins, ends = edges[::2], edges[1::2]
        long = ends - begins >= TOKEN_CHARS
        begins, ends = begins[long], ends[long]
        if not len(begins):
            return begins, ends, np.zeros(0)
        # The pairs of all tokens end to end, each after the start.
        lengths = ends - begins
        at = np.repeat(begins - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        own = codes[at]
        before = np.empty_like(own)
        before[1:] = own[:-1]
        firsts = np.cumsum(lengths) - lengths
        before[firsts] = _START
        return begins, ends, np.add.reduceat(self.ratio[before, own], firsts)


def train_models(
    documents: DataFrame,
    sample_documents: int = SAMPLE_DOCUMENTS,
    sample_chars: int = SAMPLE_CHARS,
) -> MarkovRatio | None:
    """Models trained on a bounded sample of labelled tokens, or None if none is labelled.

    The patterns label: values they find are secrets, identifiers they leave are ordinary. Of
    the distinct texts that hold a labelled value, each cut to a window of ``sample_chars``
    characters round it, the first ``sample_documents`` by hash are taken. Counts of character
    pairs are summed by Spark; the driver gets the two tables.
    """
    # Through a generator of one row, so that the patterns are not applied in each use.
    one = F.explode(F.array(training_text(F.col("text"), sample_chars))).alias("text")
    # The labelled texts are few and cut; stored, the patterns are applied once for all that
    # the choice of a sample asks of them.
    texts = stored(documents.select(one).where(F.col("text").isNotNull()), "labelled")
    sample = text_sample(texts, F.col("text").isNotNull(), sample_documents).select("text")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, _SYMBOLS, _SYMBOLS), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                for start, kind, end in spans:
                    value = text[start:end]
                    if kind == 0:
                        value = ASSIGN.match(text, start)[2]
                    _count(counts[0], value)
                rest, at = [], 0
                for start, _, end in spans:
                    rest.append(text[at:start])
                    at = max(at, end)
                rest.append(text[at:])
                for part in rest:
                    for m in IDENTIFIER.finditer(part):
                        _count(counts[1], m[0])
        label, before, after = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int64)) for x in (label, before, after, counts[label, before, after])],
            ["label", "before", "after", "n"],
        )

    pairs = sample.mapInArrow(tidy(label), "label long, before long, after long, n long")
    rows = pairs.groupBy("label", "before", "after").agg(F.sum("n").alias("n")).collect()
    tables = np.zeros((2, _SYMBOLS, _SYMBOLS))
    for r in rows:
        tables[r["label"], r["before"], r["after"]] = r["n"]
    return MarkovRatio(*tables) if tables[0].any() and tables[1].any() else None


def _count(table: np.ndarray, token: str) -> None:
    codes = _codes(token)
    np.add.at(table, (codes[:-1], codes[1:]), 1)


def model_spans(
    texts: list[str], base: list[list[tuple[int, int, int]]], models: MarkovRatio,
    threshold: float, least_mean: float = LEAST_MEAN,
) -> list[list[tuple[int, int, int]]]:
    """Per text the spans the models add: tokens apart from the base ones whose ratio reaches
    the threshold and, per character, the least mean."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    data = [t.encode() for t in texts]
    # A line break is in no token.
    starts = np.cumsum([0, *(len(d) + 1 for d in data)])
    begins, ends, scores = models.tokens(b"\n".join(data))
    chosen = (scores >= threshold) & (scores >= least_mean * (ends - begins))
    for begin, end in zip(begins[chosen].tolist(), ends[chosen].tolist()):
        n = int(np.searchsorted(starts, begin, "right")) - 1
        at = int(starts[n])
        # Spans count code points.
        first = begin - at if texts[n].isascii() else len(data[n][: begin - at].decode())
        last = first + end - begin
        if not any(s < last and first < e for s, _, e in base[n]):
            found[n].append((first, 3, last))
    return found


def scan_secrets(
    documents: DataFrame, models: MarkovRatio | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, spans`` per row: ``spans`` are ``kind, start, end`` in order of start, then
    kind, counted in code points. Without ``models`` only the patterns are applied. Null and
    empty texts have no spans; rows that repeat are each returned; other columns are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, SLICE_BYTES):
                texts = [t or "" for t in some.column(1).to_pylist()]
                base = [base_spans(t) for t in texts]
                added = model_spans(texts, base, models, threshold) if models else [[]] * len(base)
                spans = [
                    [
                        {"kind": KINDS[kind], "start": start, "end": end}
                        for start, kind, end in sorted(own + more)
                    ]
                    for own, more in zip(base, added)
                ]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(spans, _SPANS)], ["doc_id", "spans"]
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(tidy(scan), f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    )


_SPANS = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
]))
