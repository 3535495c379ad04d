"""The training-data pipeline: five stages over documents, each one operator of recordflow.llm.

A stage takes (spark, docs, sf_dir) and works on all that the stage before kept.
All but the last return the columns of documents; the last returns the ids.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from recordflow.llm import bpe, exact, mixture, quality, simhash
from recordflow.operators.staging import ensure_checkpoint_dir

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject; it learns from the labels of this corpus."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of equal texts."""
    return exact.drop_exact(docs)


def distinct_contents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return simhash.drop_near(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it."""
    return mixture.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of each document."""
    return bpe.encode(docs, RANKS, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", distinct_texts),
    ("near_dedup", distinct_contents),
    ("mixture", mixed_sources),
    ("encoding", encoded),
]

# Trained scores, near duplicates and token ids are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written as Parquet and read by the next."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4()}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
