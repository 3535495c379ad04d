"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact, lexical, licences, merkle, mixture, prefixhash, quality, recompress, shards, simhash, tokenfiles, warc
from .oracles import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, and the ids decoded again."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes: a stored map that deals slots out in turn is edited for their bytes."""
    path = tokenfiles.fresh_path(spark, "slots")
    shards.SlotMap.even(8).save(spark, path)
    return shards.shard(table(spark, sf_dir, "documents"), 8, map_path=path)


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the one that stands for their text."""
    return exact.exact_groups(table(spark, sf_dir, "documents"))


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages."""
    header = F.col("headers")
    return warc.derive_pages(table(spark, sf_dir, "pages")).select(
        "page_id",
        "kind",
        "record_id",
        "refers_to",
        header["WARC-Target-URI"].alias("target_uri"),
        header["WARC-Payload-Digest"].alias("payload_digest"),
        header["WARC-Block-Digest"].alias("block_digest"),
        F.octet_length("block").cast("long").alias("block_length"),
        F.sha2("record", 256).alias("record_sha256"),
        F.col("block").cast("string").alias("content"),
    )


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All paragraphs of all documents that license something."""
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.train(docs))


@query
def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words the mix takes of them."""
    return mixture.mix(table(spark, sf_dir, "documents"))


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their fingerprint and class of near duplicates."""
    return simhash.near_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their fingerprint, set against their edited text and the next document."""
    return prefixhash.fingerprints(table(spark, sf_dir, "documents"))


@query
def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages that a document with a smaller id also has."""
    return recompress.without_repeats(table(spark, sf_dir, "documents"))


@query
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files in the shared folder, and their ids read back."""
    import public_tokenizers

    path = tokenfiles.fresh_path(spark, "tokens")
    tokenfiles.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path, end_id=2)
    return tokenfiles.checksums(tokenfiles.read(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents ranked for all benchmark items."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their proof in the manifest, and a version for every fifth with its text in lower case."""
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), changed, merkle.lower_cased()).proofs()


__all__ = ["ORACLES", "QUERIES"]
