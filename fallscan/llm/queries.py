"""The queries of this package by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fallscan.llm import (
    bpe,
    conversation_trie,
    exact_dedup,
    filter_audit,
    licenses,
    mixing,
    near_dedup,
    quality,
    secrets,
    sharding,
    token_counts,
    toxicity,
    url_reputation,
)
from fallscan.llm.common import table


#: The vocabulary of op4 and of the pipeline; every executor has the file at this path.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_cuckoo_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op2_minhash_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op3_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with three edits that follow from its own text."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    edited = docs.withColumn("edits", token_counts.sample_edits(F.col("text")))
    return token_counts.count_edited(edited, VOCABULARY)


def op4_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), VOCABULARY)


def op5_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op8_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("detections")


def op9_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("found")


def op10_form_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    return url_reputation.judge(pages, labels).drop("host_mean", "host_upper")


def op13_removal_potential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_cuckoo_exact_dedup,
        op2_minhash_hamming_join,
        op3_edit_aware_counts,
        op4_bpe_automaton,
        op5_toxicity_trees,
        op6_entropy_mixing,
        op7_hilbert_shards,
        op8_license_rules,
        op9_credential_linking,
        op10_form_likelihood,
        op11_conversation_trie,
        op12_host_reputation,
        op13_removal_potential,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_cuckoo_exact_dedup": r"""
WITH hashed AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept,
       h AS text_sha256
FROM hashed
""",
    "op11_conversation_trie": conversation_trie.ORACLE_SQL,
    "op12_host_reputation": url_reputation.ORACLE_SQL,
    "op13_removal_potential": filter_audit.ORACLE_SQL,
}
