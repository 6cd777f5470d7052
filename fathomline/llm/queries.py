"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fathomline.llm.decontaminate import mark_contamination
from fathomline.llm.html_text import extract_main_text
from fathomline.llm.license_scan import scan_licenses
from fathomline.llm.neighbours import search
from fathomline.llm.ngram_jaccard import link_near_duplicates
from fathomline.llm.ngram_lm import score_texts
from fathomline.llm.packing import pack_documents
from fathomline.llm.pii import find_pii, summarise
from fathomline.llm.substring import remove_repeated_windows
from fathomline.llm.toxicity import score_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_hash")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise(find_pii(_table(spark, sf_dir, "documents")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return scored.selectExpr("row.doc_id AS doc_id", "held_out", "score", "predicted", "CAST(size(segments) AS BIGINT) AS n_segments")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_near_duplicates(_table(spark, sf_dir, "documents")).drop("cls")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "embeddings"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))
