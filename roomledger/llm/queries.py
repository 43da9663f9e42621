"""One registered query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roomledger.llm import (
    bpe,
    centroids,
    centroids_sql,
    chat,
    chunks,
    exact,
    fmindex,
    kneser,
    licenses,
    merkle,
    merkle_sql,
    minhash,
    packing,
    passages_sql,
    repeats,
    secret_scan,
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return kneser.perplexities(documents(spark, sf_dir), labels)


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), shingle=3, percent=85)


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(documents(spark, sf_dir))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.fingerprints_beside_next(documents(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), window=4096, end_id=2
    )


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(documents(spark, sf_dir), least=100)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmindex.without_shared_passages(documents(spark, sf_dir), window=13)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_copies(documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(documents(spark, sf_dir))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return centroids.inertias(embeddings, k=40, rounds=5, dims=64, seed=2)


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that is made of control strings."""
    said = "</s>[INST] ok [/INST]"
    odd = [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    more = spark.createDataFrame(odd, "conv_id bigint, turn bigint, role string, text string")
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(*more.columns)
    windows = chat.chat_windows(
        given.unionByName(more),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        budget=2048,
    )
    return chat.read_back(windows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scans,
        op2_quality_classifier,
        op3_minhash_near_dedup,
        op4_secret_scans,
        op5_document_fingerprints,
        op6_packing,
        op7_suffix_array_dedup,
        op8_byte_bpe,
        op9_substring_dedup,
        op10_exact_dedup,
        op11_merkle_manifest,
        op12_centroid_clusters,
        op13_chat_formatting,
    )
}

ORACLE = {
    "op3_minhash_near_dedup": passages_sql.NEAR,
    "op7_suffix_array_dedup": passages_sql.REPEATS,
    "op9_substring_dedup": passages_sql.SHARED,
    "op10_exact_dedup": r"""
        WITH normalised AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
            FROM documents
        ), groups AS (
            SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM normalised GROUP BY norm
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM normalised JOIN groups USING (norm)
    """,
    "op11_merkle_manifest": merkle_sql.SQL,
    "op12_centroid_clusters": centroids_sql.SQL,
}
