"""Batches as data: a deterministic batch_id and ordinal instead of in-memory lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import positions


def assign_batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """Consecutive runs of at most ``size`` rows in the given order: adds ``batch_id`` and ``ordinal``."""
    if size < 1:
        raise ValueError("a batch holds at least one row")
    return (
        positions(df, order)
        .withColumn("batch_id", F.floor(F.col("_pos") / size))
        .withColumn("ordinal", (F.col("_pos") % size).cast("int"))
        .drop("_pos")
    )


def split_batches(df: DataFrame, parallel: int, batch: str = "batch_id", ordinal: str = "ordinal") -> DataFrame:
    """Adds ``sub_batch``: batches with more rows than ``parallel`` are cut into runs of rows/parallel."""
    sizes = df.groupBy(batch).agg(F.count(F.lit(1)).alias("_rows"))
    run = F.when(F.col("_rows") > parallel, F.greatest(F.lit(1), F.floor(F.col("_rows") / parallel))).otherwise(
        F.col("_rows")
    )
    return df.join(sizes, batch).withColumn("sub_batch", F.floor(F.col(ordinal) / run).cast("int")).drop("_rows")


def arrival_batches(df: DataFrame, size: int) -> DataFrame:
    """Runs of at most ``size`` rows as they arrive in each partition: adds ``batch_id`` and ``ordinal``, without a shuffle.

    A recomputed partition may number its rows otherwise: materialise the result before it is read twice.
    """
    if size < 1:
        raise ValueError("a batch holds at least one row")
    numbered = df.withColumn("_id", F.monotonically_increasing_id())
    at = F.col("_id").bitwiseAND((1 << 33) - 1)
    return (
        numbered.withColumn("batch_id", (F.col("_id") - at) + F.floor(at / size))
        .withColumn("ordinal", (at % size).cast("int"))
        .drop("_id")
    )


def numbered_batches(df: DataFrame, batch: list[str], ordinal: str = "ordinal", value: str = "value") -> DataFrame:
    """One JSON array per batch for a model: ``[{"_n": ordinal, "value": text}]``. Nothing but the value is sent."""
    members = F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("_n"), F.col(value).alias("value"))))
    return df.groupBy(*batch).agg(F.count(F.lit(1)).cast("int").alias("records"), F.to_json(members).alias("batch_json"))


def serialize_batches(
    df: DataFrame, batch: list[str] | None = None, ordinal: str = "ordinal", value: str = "value"
) -> DataFrame:
    """One JSON array per batch: ``[{key?, value?, metadata?}]`` with the value as a string, in ordinal order."""
    keys = batch or ["batch_id"]
    members = [
        F.col(ordinal).alias("_o"),
        (F.col("key").cast("string") if "key" in df.columns else F.lit(None).cast("string")).alias("key"),
        F.col(value).alias("value"),
        (
            F.when(F.size("metadata") > 0, F.col("metadata"))
            if "metadata" in df.columns
            else F.lit(None).cast("map<string,string>")
        ).alias("metadata"),
    ]
    ordered = F.array_sort(
        F.collect_list(F.struct(*members)),
        lambda a, b: (a["_o"] - b["_o"]).cast("int"),
    )
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("int").alias("records"),
        F.to_json(
            F.transform(
                ordered,
                lambda m: F.struct(m["key"].alias("key"), m["value"].alias("value"), m["metadata"].alias("metadata")),
            )
        ).alias("batch_json"),
    )


def in_order(df: DataFrame, batch: str = "batch_id", ordinal: str = "ordinal") -> DataFrame:
    """Results of parallel work back in input order inside every partition-sized range of batches."""
    return df.repartitionByRange(F.col(batch), F.col(ordinal)).sortWithinPartitions(batch, ordinal)
