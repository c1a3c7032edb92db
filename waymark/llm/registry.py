"""The registered queries of this subpackage, and SQL for those it can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import line_dedup, mixing, token_files, vptree
from waymark.llm.collocations import collocations
from waymark.llm.decontaminate import contamination, is_contaminated
from waymark.llm.language_id import fold, identify_languages, reference_table
from waymark.llm.license_scan import scan_licenses
from waymark.llm.packing import pack_documents
from waymark.llm.secret_scan import scan_secrets, train_models
from waymark.llm.shared import new_folder
from waymark.llm.sharding import pack_shards
from waymark.llm.simhash import near_duplicates
from waymark.llm.whitening import whiten

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(_documents(spark, sf_dir), benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_shards(_documents(spark, sf_dir))
    return packed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def token_digest(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Writes ``documents`` as token files and sums up what is read back of each."""
    path = new_folder(spark, "token-files")
    token_files.write_token_files(documents, path, TOKENIZER)
    found = token_files.read_token_files(spark, path, TOKENIZER)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(spark, _documents(spark, sf_dir))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix_sources(_documents(spark, sf_dir)).taken()
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_documents(spark, sf_dir))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select(
        "page_id", "host",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("kept").cast("long").alias("n_kept"),
        F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(_documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    found = scan_secrets(documents, train_models(documents))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "random")), 256)
        .alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op9_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    references = reference_table(documents.where(fold(F.col("doc_id")) != 0))
    found = identify_languages(documents.select("doc_id", "text"), references)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir), TOKENIZER)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_sharding, op3_token_files, op4_mixing, op5_simhash,
        op6_line_dedup, op7_license_scan, op8_secret_scan, op9_nearest_vectors,
        op10_language_id, op11_whitening, op12_packing, op13_collocations,
    )
}

_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

ORACLES = {
    "op1_decontamination": f"""
        WITH items AS (
            SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL
        ), windows AS (
            SELECT DISTINCT item_id, least(len(w), 13) AS n,
                array_to_string(w[s : s + 12], ' ') AS win
            FROM (
                SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s
                FROM items WHERE len(w) > 0
            )
        ), docs AS (
            SELECT doc_id, {_WORDS} AS w FROM documents
        ), places AS (
            SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS win
            FROM (
                SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
                FROM docs, (SELECT DISTINCT n FROM windows) AS sizes WHERE len(w) >= n
            )
        ), found AS (
            SELECT doc_id, s, n, item_id FROM places JOIN windows USING (win, n)
        ), hit AS (
            SELECT doc_id, count(DISTINCT word) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + n)) AS word FROM found) GROUP BY doc_id
        ), owners AS (
            SELECT doc_id, count(*) AS n_items,
                string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found)
            GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
            coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN owners USING (doc_id)
    """,
    "op6_line_dedup": rf"""
        WITH cut AS (
            SELECT page_id,
                lower(regexp_extract(coalesce(url, ''), '{line_dedup.HOST}', 1)) AS host,
                list_filter(list_transform(regexp_split_to_array(regexp_replace(
                    regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
                        '{line_dedup.HIDDEN}', '', 'g'),
                        '{line_dedup.BLOCK_TAGS}', chr(10), 'g'),
                        '{line_dedup.OTHER_TAGS}', '', 'g'),
                    '[\x20\x09\x0B-\x0D]+', ' ', 'g'), '\x20?\n\x20?'),
                    lambda x: trim(x)), lambda x: x <> '') AS lines
            FROM pages
        ), totals AS (
            SELECT host, count(DISTINCT (page_id, lines)) AS pages FROM cut GROUP BY host
        ), boilerplate AS (
            SELECT host, line
            FROM (SELECT DISTINCT host, page_id, lines, unnest(lines) AS line FROM cut)
            JOIN totals USING (host)
            GROUP BY host, line, pages
            HAVING count(*) >= {line_dedup.LEAST_PAGES}
                AND count(*) > {line_dedup.RATIO} * pages
        ), dropped AS (
            SELECT host, list(line) AS gone FROM boilerplate GROUP BY host
        ), kept AS (
            SELECT page_id, host, lines,
                list_filter(lines, lambda x: NOT list_contains(coalesce(gone, []), x)) AS kept
            FROM cut LEFT JOIN dropped USING (host)
        )
        SELECT page_id, host, len(lines) AS n_lines, len(kept) AS n_kept,
            sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256
        FROM kept
    """,
}
