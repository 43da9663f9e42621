"""From raw documents to packed training sequences, one stage after another."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roomledger.llm import exact, kneser, minhash, packing, secret_scan
from roomledger.session import work_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents unlike the trusted ones of their language go."""
    return kneser.drop_unlike_trusted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, 0.8."""
    return minhash.drop_near_duplicates(docs, shingle=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced; no document goes."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences, with their ids."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("minhash near-dedup", near_dedup),
    ("secret scans", secrets),
    ("packing", pack),
]

# Perplexities, MinHash, forests and tokenizers are not SQL; tests hold the stages against others.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
