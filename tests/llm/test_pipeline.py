from collections import Counter

import plain
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from waymark.llm.decontaminate import contamination, is_contaminated
from waymark.llm.registry import TOKENIZER

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's result, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = plain.documents(spark).select(*docs.columns)
    docs = docs.unionByName(odd.selectExpr(
        "doc_id + 100000 AS doc_id", *[c for c in docs.columns if c != "doc_id"]
    ))
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = found[name] = spark.read.parquet(path)
    return found


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_stay(stages):
    columns = stages["documents"].columns
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == columns
        assert stages[name].dtypes == stages["documents"].dtypes


def test_only_documents_without_letters_have_no_language(stages):
    letters = lambda t: any(map(str.isalpha, t or ""))
    assert Counter(texts(stages["language_id"])) == Counter(
        r for r in texts(stages["documents"]) if letters(r[1])
    )


def test_clean_documents_stay_where_no_language_is_known(spark):
    rows = [*plain.ODD, (90, "the cat sat on the mat", None, None, None), (91, "12 !", None, None, None)]
    docs = plain.documents(spark, rows).withColumn("lang", F.lit(None).cast("string"))
    left = corpus_pipeline.language_id(spark, docs, SF)
    assert left.dtypes == docs.dtypes
    assert Counter(texts(left)) == Counter(
        (r[0], r[1]) for r in rows if any(map(str.isalpha, r[1] or ""))
    )
    assert (90, "the cat sat on the mat") in texts(left)


def test_one_of_each_group_stays(stages):
    before, after = texts(stages["language_id"]), texts(stages["near_dedup"])
    marks = [plain.fingerprint(t) for _, t in before]
    own = plain.groups(len(before), lambda i, j: (marks[i] ^ marks[j]).bit_count() <= 3)
    assert len(after) == len(set(own)) < len(before)
    group = dict(zip(before, own))
    assert len({group[r] for r in after}) == len(after)


def test_contaminated_documents_go(spark, stages):
    before = stages["near_dedup"]
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = {r.doc_id for r in contamination(before, benchmark).where(is_contaminated()).collect()}
    assert bad and Counter(texts(stages["decontamination"])) == Counter(
        r for r in texts(before) if r[0] not in bad
    )


def test_mixing_takes_words_of_the_documents(stages):
    given = {}
    for doc_id, text in texts(stages["decontamination"]):
        given[doc_id] = f"{given.get(doc_id, '')} {text}"
    total = Counter()
    for doc_id, text in texts(stages["mixing"]):
        assert not Counter(text.split()) - Counter(given[doc_id].split())
        total[doc_id] += len(text.encode().split())
    sizes = {d: len(t.encode().split()) for d, t in given.items()}
    assert all(total[d] <= 2 * n for d, n in sizes.items())
    assert abs(sum(total.values()) / sum(sizes.values()) - 1.5) < 0.05


def test_token_output_holds_all_that_is_left(stages):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(TOKENIZER)
    left = texts(stages["mixing"])
    rows = sorted(stages["token_output"].collect(), key=lambda r: r.start)
    counts = Counter((d, len(own.encode(t, add_special_tokens=False).ids) + 1) for d, t in left)
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == counts
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_columns_of_any_name_stay_as_they_are(spark, tmp_path):
    """Names the operators use, dots and quotes, and a language that is called undetermined."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({
        "score": F.lit(7), "lang_pred": F.lit("mine"), "determined": F.lit(False),
        "a.b": F.lit(1.5), "it`s": F.array(F.lit("x")), "row": F.lit(None).cast("string"),
        "nth": F.col("doc_id"), "k1": F.lit("k"), "leader": F.struct(F.lit(1).alias("language")),
        "given_0": F.lit(3), "pieces": F.lit("p"),
    }).withColumn("lang", F.when(F.col("lang") == "en", "und").otherwise(F.col("lang")))
    letters = {r for r in texts(docs) if any(map(str.isalpha, r[1] or ""))}
    given = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.dtypes == given.dtypes
        own = {(r.score, r.lang_pred, r["a.b"], r["it`s"][0], r.nth == r.doc_id) for r in docs.collect()}
        assert own == {(7, "mine", 1.5, "x", True)}
        if name == "language_id":
            assert set(texts(docs)) == letters
