"""Corpus preparation: toxicity, near-duplicates, benchmark decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.

Edges are the same for all stages: null and empty texts are kept as they are, rows without doc_id take part like others
(but name no group of near-copies), an empty table gives an empty result, and documents may have further columns of any
names. Of rows that repeat in doc_id and text one stays; another text under the same doc_id is a document of its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fathomline.llm import decontaminate, ngram_jaccard, packing, pii, toxicity
from fathomline.llm.shared import staged


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents judged toxic go, repeated ones alike; without labels of both classes all stay."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of least doc_id: five-word shingles, Jaccard of 0.8 or more.
    Wordless documents are like no other and stay."""
    return ngram_jaccard.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go: with words in benchmark windows, a twentieth of all words or more. An empty benchmark
    leaves all."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span found is replaced by its kind; n_chars follows the new text (null for a null one). No row goes."""
    clean = pii.redact(pii.find_pii(docs))
    return clean.selectExpr(*(f"CAST(length(text) AS {kind}) AS n_chars" if name == "n_chars" else f"`{name}`" for name, kind in docs.dtypes))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048, a row for each piece. A null or empty text is its end token alone."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: Learnt scores and tokenizer ids have no SQL; tests/llm/test_pipeline.py holds the stages against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents. Stages are chained by files in the checkpoint folder, as lineage would otherwise repeat."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
