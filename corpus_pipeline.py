"""From raw documents to token ids, one written table per stage.

Every stage reads what its predecessor kept, whole, and all but the last return the columns of
documents: quality rules and toxicity remove what they reject, near-duplicates leave one document of
each group, decontamination removes documents that hold a benchmark item, and byte-level BPE turns
the rest into ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from notelake.llm import byte_bpe, decontaminate, near_dup, quality, toxicity
from notelake.session import fresh_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, public_tokenizers.path("piece_bpe_32k.model"))


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocab = public_tokenizers.path("byte_bpe_50k.json")
    return byte_bpe.digest_texts(docs, vocab, with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", clean_language),
    ("near-duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("token ids", token_ids),
]

# Trained models, tokenizers and alignments have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
