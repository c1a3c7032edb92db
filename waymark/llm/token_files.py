"""Token-id files: documents compressed one by one under a shared dictionary.

A file set is a folder with two Parquet tables, written and committed by Spark. ``dictionary``
holds the zstandard dictionary, trained on serialized id arrays, and its hash. ``blocks`` holds
runs of documents in ascending id order: the compressed documents end to end, the number of
ids before them in their part of the table, and an index of where each document begins, which is a column of its own and so is read without the data. Every block
names its dictionary's hash, and a document is decompressed by itself.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.shared import slices, small, stored, text_sample, tidy

END_ID = 0
LEVEL = 3
DICTIONARY_BYTES = 65_536
# The sample the dictionary is trained on: so many documents, none longer than this.
SAMPLE_DOCUMENTS = 1_000
SAMPLE_CHARS = 8_000
BLOCK_BYTES = 1_000_000
BLOCK_DOCUMENTS = 4_096
# Runs of text a worker remembers as recent, and their characters, and as many from before.
REMEMBERED = 150_000
REMEMBERED_CHARS = 3_000_000
# Texts are cut into runs so many characters at a time.
PART_CHARS = 2_000_000

_BLOCKS = (
    "part int, block int, before long, dictionary_hash string, frames binary, "
    "documents array<struct<doc_id: bigint, offset: bigint, length: bigint, n_tokens: bigint>>"
)


class Encoder:
    """Encodes texts with a tokenizer file, remembering what it has met.

    A byte-level tokenizer first splits a text into runs of letters, digits and marks, each
    with a space ahead if there is one, and applies its merges within a run. So runs are
    encoded on their own, once each, with the same ids as in the whole text. Plain characters
    are split here, whole batches of texts at once; a piece between spaces that holds others is
    left whole to the tokenizer, and so is all text if the file names another splitting. New
    runs are encoded many at a time, and told apart by the tokens that begin with a space or
    are a line break. Runs not met for a while are forgotten: when the recent ones are many or
    large, those before them go.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        size = self._tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 65_536 else "<u4")
        self._begins = np.zeros(size, bool)
        space = self._tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        for token, number in self._tokenizer.get_vocab().items():
            self._begins[number] = token.startswith(space)
        self._line = self._tokenizer.encode("\n", add_special_tokens=False).ids
        known = json.loads(self._tokenizer.to_str())
        split = known.get("pre_tokenizer") or {}
        self._added = [t["content"] for t in known.get("added_tokens", [])]
        self._splits = (
            split.get("type") == "ByteLevel" and split.get("use_regex") is True
            and not split.get("add_prefix_space") and known.get("normalizer") is None
            and len(self._line) == 1 and not any(re.search(r"\s", t) for t in self._added)
        )
        self._recent: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}
        self._size = 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """Serialized ids of each text."""
        if not self._splits:
            return self._ids(texts)
        found: list[list[bytes]] = [[] for _ in texts]
        some: list[tuple[int, str]] = []
        size = 0
        for n, text in enumerate(texts):
            for part in _parts(text):
                some.append((n, part))
                size += len(part)
                if size >= PART_CHARS:
                    self._encode_parts(some, found)
                    some, size = [], 0
        self._encode_parts(some, found)
        return [parts[0] if len(parts) == 1 else b"".join(parts) for parts in found]

    def _encode_parts(self, parts: list[tuple[int, str]], found: list[list[bytes]]) -> None:
        plain, other = [], []
        for n, text in parts:
            held = _PLAIN.fullmatch(text) and not any(t in text for t in self._added)
            (plain if held else other).append((n, text))
        for some, cut in ((plain, _plain_runs), (other, self._other_runs)):
            if some:
                for (n, _), ids in zip(some, self._joined(*cut([t for _, t in some]))):
                    found[n].append(ids)

    def _other_runs(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The runs of texts with any characters, and where those of each text begin."""
        runs, edges = [], [0]
        for text in texts:
            for n, piece in enumerate(_CUT.split(text)):
                own = " " + piece if n else piece
                if _SPLIT.fullmatch(piece) and not any(t in piece for t in self._added):
                    runs += _RUNS.findall(own)
                elif own:
                    runs.append(own)
            edges.append(len(runs))
        return pa.array(runs, pa.large_string()), np.array(edges)

    def _joined(self, runs: pa.Array, edges: np.ndarray) -> Iterator[bytes]:
        """Serialized ids of texts given as runs."""
        coded = runs.dictionary_encode()
        own = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self._recent) > REMEMBERED or self._size > REMEMBERED_CHARS:
            self._recent, self._before, self._size = {}, self._recent, 0
        self._learn(set(own).difference(self._recent))
        known = list(map(self._recent.__getitem__, own))
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // self.dtype.itemsize
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(known), self.dtype)
        codes = coded.indices.to_numpy()
        n_ids = lengths[codes]
        ends = np.concatenate([[0], np.cumsum(n_ids)])
        # Where each id of the texts stands among those of the different runs.
        at = np.repeat(starts[codes] - ends[:-1], n_ids)
        at += np.arange(len(at))
        ids = flat[at]
        bounds = ends[edges].tolist()
        for a, b in zip(bounds, bounds[1:]):
            yield ids[a:b].tobytes()

    def _learn(self, runs: set[str]) -> None:
        recent, before = self._recent, self._before
        known = runs & before.keys()
        recent.update((r, before[r]) for r in known)
        spaced, inside, alone = [], [], []
        for r in runs - known:
            # White space at an end would join what is put beside it.
            if r[-1].isspace():
                alone.append(r)
            elif r[0] == " ":
                spaced.append(r)
            else:
                (alone if r[0].isspace() else inside).append(r)
        for at in range(0, len(spaced), 512):
            self._remember(spaced[at : at + 512], "", self._begins)
        for at in range(0, len(inside), 512):
            self._remember(inside[at : at + 512], "\n", None)
        recent.update(zip(alone, self._ids(alone)))
        self._size += sum(map(len, runs))

    def _remember(self, runs: list[str], ahead: str, begins: np.ndarray | None) -> None:
        """Runs that have a space ahead, or else are given a line break ahead to part them."""
        data = self._ids([ahead + ahead.join(runs)])[0]
        ids = np.frombuffer(data, self.dtype)
        first = np.flatnonzero(ids == self._line[0] if begins is None else begins[ids])
        if len(first) == len(runs):
            width = self.dtype.itemsize
            starts = ((first + (begins is None)) * width).tolist()
            ends = [*(first[1:] * width).tolist(), len(data)]
            made = [data[a:b] for a, b in zip(starts, ends)]
        else:
            made = self._ids(runs)
        self._recent.update(zip(runs, made))

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = []
        for at in range(0, len(texts), 1024):
            batch = self._tokenizer.encode_batch_fast(
                texts[at : at + 1024], add_special_tokens=False
            )
            found += [np.array(e.ids, self.dtype).tobytes() for e in batch]
        return found


def _parts(text: str) -> Iterator[str]:
    """The text in parts of some ``PART_CHARS``, cut ahead of a space between two others."""
    begin = 0
    while len(text) - begin > PART_CHARS:
        cut = _CUT.search(text, begin + PART_CHARS)
        if not cut:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


def _plain_runs(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The runs of texts of plain characters, and where those of each text begin.

    Runs change with the kind of character. Of white space ahead of other characters the last
    one is a run of its own, which a space leaves to the run that follows.
    """
    data = [t.encode() for t in texts]
    joined = b"".join(data)
    text = np.frombuffer(joined, np.uint8)
    edges = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    kind = _KINDS[text]
    begins = np.zeros(len(text) + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=begins[1:-1])
    begins[edges] = True
    last = np.zeros(len(text) + 1, bool)
    last[edges] = True
    white = np.flatnonzero((kind == _WHITE_KIND) & begins[1:] & ~last[1:])
    begins[white] = True
    begins[white[text[white] == ord(" ")] + 1] = False
    starts = np.flatnonzero(begins)
    offsets = pa.array(starts, pa.int64()).buffers()[1]
    runs = pa.LargeStringArray.from_buffers(len(starts) - 1, offsets, pa.py_buffer(joined))
    return runs, np.searchsorted(starts, edges)


# A space with no white space on either side.
_CUT = re.compile(r"(?<!\s) (?!\s)")
# Characters (Latin, Cyrillic and ideographic letters, digits, marks, white space)
# whose kind is known, and how byte-level tokenizers split text of these. Plain ones are told
# apart by their bytes; the apostrophe, which also opens endings, is not among them.
_LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u017F\u0400-\u0481\u4E00-\u9FA5"
_DIGITS = "0-9"
_MARKS = r"""!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"""
_MORE_MARKS = r"'\u2010-\u2027\u2030-\u205E"
_WHITE = r" \t\n\r\x0B\x0C"
_PLAIN = re.compile(f"[{_LETTERS}{_DIGITS}{_MARKS}{_WHITE}]*")
_SPLIT = re.compile(f"[{_LETTERS}{_DIGITS}{_MARKS}{_MORE_MARKS}{_WHITE}]*")
_RUNS = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[{_MARKS}{_MORE_MARKS}]+"
    rf"|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)
_WHITE_KIND = 3
_KINDS = np.zeros(256, np.uint8)
for _kind, _of in enumerate((_DIGITS, _MARKS, _WHITE), 1):
    _KINDS[[n for n in range(128) if re.fullmatch(f"[{_of}]", chr(n))]] = _kind
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's own encoder for a file; workers serve many tasks and keep it."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _serialized(texts: list[str | None], path: str, end_id: int) -> list[bytes]:
    own = encoder(path)
    end = np.array([end_id], own.dtype).tobytes()
    return [ids + end for ids in own.encode([t or "" for t in texts])]


def train_dictionary(
    documents: DataFrame,
    tokenizer: str,
    end_id: int = END_ID,
    sample_documents: int = SAMPLE_DOCUMENTS,
    sample_chars: int = SAMPLE_CHARS,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> bytes:
    """A dictionary trained on the serialized ids of a bounded sample: of the texts that are
    not empty, the ``sample_documents`` first by hash, each once however many copies it has, and
    of those over ``sample_chars`` characters a window of that length at a place their hash
    gives. Too few to train on are joined to a dictionary of plain content; none give an empty
    one."""
    chosen = text_sample(documents, F.length("text") > 0, sample_documents)
    spare = F.greatest(F.length("text") - sample_chars, F.lit(0))
    begin = (F.pmod(F.col("mark"), spare + 1) + 1).cast("int")
    sample = chosen.select(F.substring("text", begin, F.lit(sample_chars)).alias("text"))

    def train(found: pd.DataFrame) -> pd.DataFrame:
        samples = _serialized(found["text"].tolist(), tokenizer, end_id)
        try:
            made = zstandard.train_dictionary(dictionary_bytes, samples).as_bytes()
        except zstandard.ZstdError:
            made = b"".join(samples)[-dictionary_bytes:]
        return pd.DataFrame({"dictionary": [made]})

    made = sample.groupBy().applyInPandas(train, "dictionary binary").first()
    return bytes(made["dictionary"]) if made else b""


def _dictionary(data: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(data)} if len(data) >= 8 else {}


def write_token_files(
    documents: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    level: int = LEVEL,
    **sample,
) -> None:
    """Encode every whole text and write the file set to ``path``, in ascending order of id.

    A null text is an empty one; each document ends in ``end_id``. Null ids come first, rows
    of one id in the order of their texts. Other columns are ignored. ``sample`` goes to
    ``train_dictionary``.
    """
    spark = documents.sparkSession
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train_dictionary(documents, tokenizer, end_id, **sample)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.range(1).select(
        F.lit(digest).alias("dictionary_hash"),
        F.lit(bytearray(dictionary)).alias("dictionary"),
        F.lit(tokenizer.rpartition("/")[2]).alias("tokenizer"),
        F.lit(end_id).alias("end_id"),
    ).write.parquet(f"{path}/dictionary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        press = zstandard.ZstdCompressor(level=level, **_dictionary(dictionary))
        width = encoder(tokenizer).dtype.itemsize
        frames: list[bytes] = []
        index: list[dict] = []
        size = block = before = 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{
                    "part": part, "block": block, "before": before, "dictionary_hash": digest,
                    "frames": b"".join(frames), "documents": index,
                }],
                schema=_BLOCK_SCHEMA,
            )

        for batch in batches:
            # Some texts at a time, so that not all of a batch are held twice.
            for some in slices(batch):
                ids, texts = (c.to_pylist() for c in some.columns)
                for doc_id, data in zip(ids, _serialized(texts, tokenizer, end_id)):
                    frame = press.compress(data)
                    index.append({
                        "doc_id": doc_id, "offset": size, "length": len(frame),
                        "n_tokens": len(data) // width,
                    })
                    frames.append(frame)
                    size += len(frame)
                    if size >= BLOCK_BYTES or len(index) >= BLOCK_DOCUMENTS:
                        yield made()
                        before += sum(d["n_tokens"] for d in index)
                        frames, index, size, block = [], [], 0, block + 1
        if index:
            yield made()

    # Ranges are of ids and how texts begin, so that rows of one id, or of none, need not meet
    # in one task and the sample that sets the ranges holds no whole texts.
    ranged = documents.repartitionByRange("doc_id", F.substring("text", 1, 12))
    ordered = ranged.sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(tidy(pack), _BLOCKS).write.parquet(f"{path}/blocks")


_BLOCK_SCHEMA = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()),
    ("dictionary_hash", pa.string()),
    ("frames", pa.binary()),
    ("documents", pa.list_(pa.struct([
        ("doc_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()),
        ("n_tokens", pa.int64()),
    ]))),
])


def _dictionaries(spark: SparkSession, path: str) -> tuple[bytes, str]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    data = bytes(row["dictionary"])
    if hashlib.sha256(data).hexdigest() != row["dictionary_hash"]:
        raise ValueError(f"{path}: the dictionary does not match its hash")
    return data, row["dictionary_hash"]


def _unpacker(data: bytes, digest: str, dtype: np.dtype):
    press = zstandard.ZstdDecompressor(**_dictionary(data))

    def ids(frame: bytes, named: str) -> np.ndarray:
        if named != digest:
            raise ValueError(f"a block asks for dictionary {named}, the file set has {digest}")
        return np.frombuffer(press.decompress(frame), dtype)

    return ids


def read_token_files(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document: ``start`` counts the ids of all
    documents before it, ``ids`` are 32-bit little-endian numbers end to end."""
    data, digest = _dictionaries(spark, path)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    n = F.aggregate("documents.n_tokens", F.lit(0).cast("long"), lambda a, b: a + b)
    # Blocks know the ids before them in their part; what is left to add up is a row per part,
    # of which there are as many as tasks that wrote.
    parts = blocks.groupBy("part").agg(F.sum(n).alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(
        parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start")), "parts"
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _unpacker(data, digest, encoder(tokenizer).dtype)
        for batch in batches:
            for row in range(batch.num_rows):
                start, named = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                frames, index = batch.column(2)[row].as_buffer(), batch.column(3)[row].as_py()
                view = memoryview(frames)
                for at in range(0, len(index), 256):
                    some = index[at : at + 256]
                    whole = [
                        ids(view[d["offset"] : d["offset"] + d["length"]], named).astype("<u4")
                        for d in some
                    ]
                    counts = np.array([len(w) for w in whole], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([d["doc_id"] for d in some], pa.int64()),
                            pa.array(start + np.cumsum(counts) - counts, pa.int64()),
                            pa.array(counts, pa.int64()),
                            pa.array([w.tobytes() for w in whole], pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )
                    start += int(counts.sum())

    found = blocks.join(small(parts, parts.count()), "part")
    start = (F.col("start") + F.col("before")).alias("start")
    return found.select(start, "dictionary_hash", "frames", "documents").mapInArrow(tidy(unpack), "doc_id long, start long, n_tokens long, ids binary"
    )


def read_document(spark: SparkSession, path: str, tokenizer: str, doc_id: int) -> list[list[int]]:
    """The ids of each document of that id, by the index: only its block's data is read."""
    data, digest = _dictionaries(spark, path)
    ids = _unpacker(data, digest, encoder(tokenizer).dtype)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    at = F.explode(F.filter("documents", lambda d: d["doc_id"] == doc_id)).alias("d")
    found = blocks.select("dictionary_hash", "frames", at).select(
        "dictionary_hash",
        F.expr("substring(frames, int(d.offset) + 1, int(d.length))").alias("frame"),
    )
    return [ids(bytes(r["frame"]), r["dictionary_hash"]).tolist() for r in found.collect()]
