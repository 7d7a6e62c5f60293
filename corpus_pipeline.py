"""The corpus pipeline: documents through five stages, each written as Parquet and read again.

1. quality rules: documents that the rules reject go;
2. exact dedup: of equal texts one document stays;
3. SimHash near-dedup: of each component of close fingerprints one document stays;
4. mixing: documents repeat, or drop out, so that the sources' words come near their targets;
5. BPE: every document that is left is encoded and decoded; per document the token count and digests.

Some stages can't be told in SQL (fingerprints, BPE), so ORACLE_SQL is None; the tests check the rows by brute force.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strandmill.llm import bpe, exact_dedup, mixing, quality, simhash
from strandmill.llm.queries import vocabulary_path
from strandmill.session import shared_dir


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_low_quality(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_documents(docs)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, vocabulary_path())


STAGES = [
    ("quality_rules", reject_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe_round_trip", encode_and_decode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns lies in the shared folder."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
