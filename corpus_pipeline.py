"""The corpus pipeline: documents in, token files out.

``STAGES`` lists name and function of each stage. A stage takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which is written as Parquet and read again as the next one's documents.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.decontaminate import contamination, is_contaminated
from waymark.llm.language_id import fold, holds_letter, judge_languages, reference_table
from waymark.llm.mixing import mixed_documents
from waymark.llm.registry import token_digest
from waymark.llm.shared import quoted, row_keys, stored
from waymark.llm.simhash import one_of_each


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no language, for want of text or letters, go."""
    references = reference_table(docs.where(fold(F.col("doc_id")) != 0))
    if references.isEmpty():
        # With no language learnt nothing is told apart but what has letters.
        return docs.where(holds_letter("text"))
    # Under names of their own, no column of the documents is taken for a result.
    names = [c if c == "text" else f"given_{n}" for n, c in enumerate(docs.columns)]
    found = judge_languages(docs.toDF(*names), references).where("determined")
    return found.select(*names).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a benchmark contaminates go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(docs, benchmark).where(is_contaminated()).select("k1", "k2").distinct()
    row = docs.select(F.struct(*quoted(docs.columns)).alias("row"), *row_keys())
    return row.join(found, ["k1", "k2"], "left_anti").select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each turn through a source that takes words of a document is a row with those words."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all that is left, and what is read back from them."""
    return token_digest(spark, docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

# SQL can express neither the parses, the fingerprints, the draws nor the tokenizer; the tests
# hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
