"""From raw documents to token digests: toxicity, exact and near duplicates, mixture, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All
but the last return the columns of ``docs``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fallscan.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from fallscan.llm.common import prepare, table
from fallscan.llm.queries import VOCABULARY


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity score rejects."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of equal texts."""
    prepare(spark)
    return exact_dedup.unique(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    prepare(spark)
    return near_dedup.representatives(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    prepare(spark)
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of token ids and of the decoded text, a row per document of the mix."""
    prepare(spark)
    return bpe.encode_documents(docs, VOCABULARY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", tokens),
]

#: Gradient-boosted trees, signatures and Newton iterations have no SQL form; the tests
#: compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again.

    The files go to the shared folder named by ``spark.checkpoint.dir``, or below the warehouse
    where that is unset, as in tests.
    """
    docs = table(spark, sf_dir, "documents")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.conf.get("spark.sql.warehouse.dir")
    home = f"{shared.rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{home}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
