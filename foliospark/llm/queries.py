"""Registered queries of the training-data operators, with their SQL where SQL can express them.

Each takes (spark, sf_dir) and applies one operator, with production
parameters, to its whole table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, edit_counts, html_extract, kneser_ney, lines, lm, packing, sentencepiece_codec, simhash
from . import exact_dedup as exact
from .common import table


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file lies on this machine; FOLIOSPARK_TOKENIZERS names another folder."""
    folder = os.environ.get("FOLIOSPARK_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents")).drop("root")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of the kept text: its length and SHA-256."""
    kept = lines.line_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digest(table(spark, sf_dir, "documents"), sentencepiece_codec.Codec(tokenizer_file("piece_bpe_32k.model")))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda v: v % 20 == 0)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0").select("doc_id")
    return kneser_ney.classify(table(spark, sf_dir, "documents"), trusted)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits of every document (a deletion at a third, a replacement at the middle, an addition at the end), counted from kept trees."""
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken")
    kept = edit_counts.keep_trees(table(spark, sf_dir, "documents"), *files)
    size = F.length("text").cast("long")
    edit = lambda start, delete, insert: F.struct(start.cast("long").alias("start"), F.lit(delete).cast("long").alias("delete"), F.lit(insert).alias("insert"))
    edits = F.array(edit(F.floor(size / 3), 12, ""), edit(F.floor(size / 2), 5, " re-written in 2024"), edit(size + 1000, 0, "\nThe end."))
    counted = edit_counts.count_edited(kept, edits, *files, tree_col="tree", digest=True)
    return counted.select("doc_id", "tokens_before", "tokens_after", "n_edits", "reencoded_chars", "n_chars")


QUERIES = {
    f.__name__: f
    for f in (op1_lm_scoring, op2_line_dedup, op3_exact_dedup, op4_sentencepiece, op5_ann, op6_packing, op7_html_extraction, op8_simhash, op9_quality, op10_token_counts)
}

ORACLE_SQL = {
    "op3_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       CAST(count(*) OVER (PARTITION BY text_sha256) AS BIGINT) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM n
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_cp DESC, doc_id)
""",
}
