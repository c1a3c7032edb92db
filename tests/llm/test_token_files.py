import random
import zlib

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waymark.llm import shared, token_files
from waymark.llm.registry import TOKENIZER, token_digest

HARD = [
    "plain words, and it's done.\nNext line", "  two  spaces ", " lead", "trail ", "a\n\n b",
    "tab\tand   wide", "é ü ñ 漢字 emoji 🙂 mixed", "don't 12 34.5 -- ... x", "", " ", "\n",
    "a \n b", "x" * 5_000, "one  " * 50, " em space  ", "end\x1c \x1cgroup",
]


def encoded(texts):
    own = Tokenizer.from_file(TOKENIZER)
    return [[*own.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def test_pieces_give_the_ids_of_the_whole_text():
    own = token_files.Encoder(TOKENIZER)
    assert [np.frombuffer(b, own.dtype).tolist() + [0] for b in own.encode(HARD)] == encoded(HARD)


def test_any_mixture_of_characters():
    dice = random.Random(5)
    some = [*"ab zZé1²½'\".,\n\t  <|>!?-_ ×÷ſƀжü\x1c\x85\u3000漢🙂\r'", "<|endoftext|>", "'s",
            "'ll", "\n\n", "  ", "word", "12", " the", "\u00a0", "\u2019", "\u0300"]
    texts = ["".join(dice.choices(some, k=dice.randrange(40))) for _ in range(4000)]
    texts += ["".join(dice.choices("ab .,\n\tÉ1", k=dice.randrange(60))) for _ in range(4000)]
    own = token_files.Encoder(TOKENIZER)
    for at in range(0, len(texts), 500):
        few = texts[at : at + 500]
        assert [np.frombuffer(b, own.dtype).tolist() + [0] for b in own.encode(few)] == encoded(few)


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(token_files, "PART_CHARS", 10)
    text = "some words  and\nmore, of don't and 🙂 words " * 50
    own = token_files.Encoder(TOKENIZER)
    got = [np.frombuffer(b, own.dtype).tolist() + [0] for b in own.encode([text, "", text[5:]])]
    assert got == encoded([text, "", text[5:]])


def test_slices_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(shared, "SLICE_BYTES", 10)
    monkeypatch.setattr(shared, "SLICE_ROWS", 3)
    texts = ["x" * n for n in (30, 0, 1, 2, 3, 4, 5, 6, 50)] + [None, "a"]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    cut = list(shared.slices(batch))
    assert [t for s in cut for t in s.column(1).to_pylist()] == texts
    assert all(s.num_rows == 1 or sum(len(t or "") for t in s.column(1).to_pylist()) <= 10
               for s in cut)
    assert max(s.num_rows for s in cut) <= 3


def test_dictionary_of_long_texts_only(spark):
    rows = [(n, " ".join(f"word{(n * 7 + k) % 500}" for k in range(2_000)), None, None, None)
            for n in range(40)]
    made = token_files.train_dictionary(plain.documents(spark, rows), TOKENIZER)
    assert len(made) > 1_000


def test_pieces_are_forgotten_when_there_are_too_many(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 5)
    own = token_files.Encoder(TOKENIZER)
    for _ in range(2):
        got = [np.frombuffer(b, own.dtype).tolist() + [0] for b in own.encode(HARD[:8])]
        assert got == encoded(HARD[:8])


@pytest.mark.parametrize("rows", ["corpus", "odd", "few"])
def test_round_trip_in_order(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_DOCUMENTS", 7)
    if rows == "corpus":
        docs = plain.corpus(spark).repartition(3)
    elif rows == "odd":
        docs = plain.documents(spark)
    else:
        docs = plain.documents(spark, [(9, "only one", None, None, None)])
    path = str(tmp_path / "files")
    token_files.write_token_files(docs, path, TOKENIZER)
    found = token_files.read_token_files(spark, path, TOKENIZER).collect()
    found.sort(key=lambda r: r.start)
    given = sorted(
        ((r.doc_id, r.text) for r in docs.collect()),
        key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1]),
    )
    ids = encoded([t for _, t in given])
    assert [r.doc_id for r in found] == [d for d, _ in given]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in found] == ids
    starts = np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert [(r.start, r.n_tokens) for r in found] == list(zip(starts, map(len, ids)))
    some = given[-1][0]
    own = [i for (d, _), i in zip(given, ids) if d == some]
    assert sorted(token_files.read_document(spark, path, TOKENIZER, some)) == sorted(own)


def test_digest_and_empty_table(spark):
    assert token_digest(spark, plain.empty(spark)).count() == 0
    row = token_digest(spark, plain.documents(spark, [(1, "a b", None, None, None)])).first()
    data = np.array(encoded(["a b"])[0], "<u4").tobytes()
    assert (row.start, row.n_tokens, row.ids_crc32) == (0, len(data) // 4, zlib.crc32(data))


def test_a_wrong_dictionary_is_refused(spark, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(plain.corpus(spark), path, TOKENIZER)
    own = spark.read.parquet(f"{path}/dictionary").withColumn("dictionary_hash", F.lit("other"))
    own.write.parquet(str(tmp_path / "other" / "dictionary"))
    with pytest.raises(ValueError):
        token_files.read_token_files(spark, str(tmp_path / "other"), TOKENIZER)
