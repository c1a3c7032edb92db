import zlib

import plain
import pytest

from pyspark.sql import functions as F

from waymark.llm import language_id
from waymark.llm.language_id import (
    CrossParser,
    identify_languages,
    learn_references,
    reference_table,
    letters_only,
    suffix_automaton,
)
from waymark.llm.registry import op10_language_id


def phrases(text, reference):
    count = at = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in reference:
            end += 1
        at = max(at + 1, end - 1)
        count += 1
    return count


REFERENCES = {
    "en": letters_only("the cat sat on the mat and the dog ran after it all day"),
    "de": letters_only("die katze saß auf der matte und der hund lief ihr nach"),
    "zh": letters_only("猫坐在垫子上 狗跟着它跑了一整天"),
}


@pytest.mark.parametrize("lanes", [1, 3, 1000])
def test_phrases_equal_brute_force(monkeypatch, lanes):
    monkeypatch.setattr(language_id, "LANES", lanes)
    texts = [letters_only(t) for t in [
        "the dog sat", "der hund", "xyz", "", "q", "the cat sat on the mat", "Die Straße 12 !!",
        "狗跟着", "aaaa" * 50, "the dog and der hund " * 40, "é",
    ]]
    parser = CrossParser(REFERENCES)
    found = parser.phrases(texts)
    for n, text in enumerate(texts):
        for m, language in enumerate(parser.languages):
            assert found[n][m] == phrases(text, REFERENCES[language]), (text, language)


def test_automaton_reads_exactly_the_runs():
    text = b"abcbcabb"
    moves, _ = suffix_automaton(text)
    runs = {text[a:b] for a in range(len(text)) for b in range(a, len(text) + 1)}

    def reads(word):
        state = 0
        for symbol in word:
            if symbol not in moves[state]:
                return False
            state = moves[state][symbol]
        return True

    import itertools

    for size in range(5):
        for word in map(bytes, itertools.product(b"abcd", repeat=size)):
            assert reads(word) == (word in runs)


def test_predictions(spark):
    rows = plain.ODD + [(90, "the dog ran after the cat", None, None, None),
                        (91, "der hund lief auf der matte", None, None, None),
                        (92, "狗坐在垫子上", None, None, None), (93, "the cat " * 20_000, None, None, None)]
    docs = plain.documents(spark, rows)
    found = identify_languages(docs, REFERENCES)
    assert found.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]
    by_id = {r.doc_id: r for r in found.collect()}
    assert [by_id[n].lang_pred for n in (90, 91, 92, 93)] == ["en", "de", "zh", "en"]
    assert all(by_id[n].lang_pred == "und" and by_id[n].score == 0 for n in (1, 2, 3, 4))
    assert all(0 <= r.score <= 1 for r in by_id.values()) and found.count() == len(rows)
    assert {r.lang_pred for r in identify_languages(docs, {}).collect()} == {"und"}
    assert identify_languages(plain.empty(spark), REFERENCES).count() == 0


def test_learning_is_bounded_and_repeats(spark):
    docs = plain.corpus(spark)
    found = learn_references(docs, reference_bytes=3_000, sample_documents=5)
    assert set(found) == {"en", "de", "fr", "es"}
    assert all(0 < len(text) <= 3_000 for text in found.values())
    assert found == learn_references(docs.repartition(7), reference_bytes=3_000, sample_documents=5)
    assert learn_references(plain.empty(spark)) == {}
    assert learn_references(plain.documents(spark).where("doc_id < 5")) == {}


def test_copies_do_not_crowd_out_other_texts(spark):
    texts = [f"the {word} of the day" for word in ("cat", "dog", "mat", "sun", "sea", "sky")]
    rows = [(n, t, "en", None, None) for n, t in enumerate(texts)]
    docs = plain.documents(spark, rows)
    copies = [(100 + n, texts[0], "en", None, None) for n in range(50)]
    found = learn_references(plain.documents(spark, rows + copies), sample_documents=6)
    assert found == learn_references(docs, sample_documents=6)
    assert all(letters_only(t) in found["en"] for t in texts)


def test_long_texts_teach_their_language(spark):
    book = "der hund lief auf der matte und die katze saß " * 500
    rows = [(1, "12345 " * 1_000 + book, "de", None, None), (2, "the cat sat", "en", None, None)]
    found = learn_references(plain.documents(spark, rows))
    assert set(found) == {"de", "en"}
    assert found["de"] == letters_only(book[:4_000])


def test_letterless_texts_take_no_place_in_the_sample(spark):
    rows = [(n, f"{n} -- {n * n} !!", "en", None, None) for n in range(60)]
    rows.append((100, "the cat sat", "en", None, None))
    found = learn_references(plain.documents(spark, rows), sample_documents=3)
    assert found == {"en": letters_only("the cat sat")}


def test_more_languages_than_a_block_holds(spark, monkeypatch):
    docs = plain.corpus(spark)
    odd = plain.documents(spark, [*plain.ODD, (7, "equally unlike all: q", None, None, None)])
    references = learn_references(docs, reference_bytes=500)
    references |= {f"{l}-{n}": t for l, t in references.items() for n in range(9)}
    given = odd.select("doc_id", "text").union(docs.select("doc_id", "text").limit(60))
    found = lambda: sorted(map(str, identify_languages(given, references).collect()))
    assert len(references) == 40
    blocks = found()
    monkeypatch.setattr(language_id, "BLOCK_LANGUAGES", 7)
    assert found() == blocks
    monkeypatch.setattr(language_id, "BLOCK_LANGUAGES", 100)
    assert found() == blocks


def test_references_stay_in_a_table(spark, monkeypatch):
    """Any number of labels: a block at a time comes to the driver."""
    monkeypatch.setattr(language_id, "BLOCK_LANGUAGES", 8)
    rows = [(n, f"word {chr(0x4E00 + n) * 3}", f"l{n:02}", None, None) for n in range(30)]
    docs = plain.documents(spark, rows)
    table = reference_table(docs)
    assert [r.number for r in table.orderBy("lang").collect()] == list(range(30))
    found = identify_languages(docs.withColumn("leader", F.lit(1)), table)
    assert {r.doc_id: (r.lang_pred, r.leader) for r in found.collect()} == {
        r[0]: (r[2], 1) for r in rows}
    assert {r.lang_pred for r in identify_languages(docs, table.limit(0)).collect()} == {"und"}


def test_many_languages_are_all_learnt(spark):
    rows = [(n, f"word {chr(0x4E00 + n) * 3}", f"l{n:02}", None, None) for n in range(70)]
    docs = plain.documents(spark, rows)
    found = identify_languages(docs, learn_references(docs)).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {r[0]: r[2] for r in rows}


def test_held_out_accuracy(spark):
    found = op10_language_id(spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    own = {r.doc_id: r.lang for r in docs}
    out = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert len(found) == len(docs)
    assert sum(r.lang_pred == own[r.doc_id] for r in out) >= 0.95 * len(out)
