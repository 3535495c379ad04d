"""Incremental reads: predicates and order on the source table, and the offset to resume from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.staging import running_max

MODES = ("bulk", "timestamp", "incrementing", "timestamp+incrementing")


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None, **options) -> DataFrame:
    """A table or a custom query; filters, columns and limits applied later are pushed to the database.

    Pass partitionColumn, lowerBound, upperBound and numPartitions to read a
    large table in parallel.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    reader = spark.read.format("jdbc").option("url", url)
    reader = reader.option("dbtable", table if table is not None else f"({query}) q")
    for name, setting in options.items():
        reader = reader.option(name, setting)
    return reader.load()


def read_incremental(
    df: DataFrame,
    mode: str = "bulk",
    ts_col: str | None = None,
    id_col: str | None = None,
    offset: dict | None = None,
    limit: int = 0,
    ordered: bool = True,
) -> DataFrame:
    """Rows after an offset ``{"ts": ..., "id": ...}``, in order, at most ``limit`` (0 = all).

    timestamp: strictly newer, so ties at a page boundary are lost; incrementing:
    greater id; timestamp+incrementing: newer, or equal with a greater id, which
    loses nothing. A part of the offset that is missing drops its predicate.
    ``ordered=False`` skips the global sort where no limit needs it.
    """
    if mode not in MODES:
        raise ValueError(f"unknown read mode: {mode}")
    offset = offset or {}
    ts, ident = offset.get("ts"), offset.get("id")
    order: list[str] = []
    if mode == "timestamp":
        order = [ts_col]
        if ts is not None:
            df = df.filter(F.col(ts_col) > F.lit(ts))
    elif mode == "incrementing":
        order = [id_col]
        if ident is not None:
            df = df.filter(F.col(id_col) > F.lit(ident))
    elif mode == "timestamp+incrementing":
        order = [ts_col, id_col]
        if ts is not None and ident is not None:
            # The plain range on the time column is what the scan can prune on.
            df = df.filter(
                (F.col(ts_col) >= F.lit(ts))
                & ((F.col(ts_col) > F.lit(ts)) | (F.col(id_col) > F.lit(ident)))
            )
        elif ts is not None:
            df = df.filter(F.col(ts_col) > F.lit(ts))
        elif ident is not None:
            df = df.filter(F.col(id_col) > F.lit(ident))
    if order and (ordered or limit > 0):
        df = df.orderBy(*order)
    return df.limit(limit) if limit > 0 else df


def next_offset(df: DataFrame, mode: str, ts_col: str | None = None, id_col: str | None = None) -> DataFrame:
    """One row with the offset of the last row in read order (NULLs when nothing was read)."""
    if mode == "timestamp":
        return df.agg(F.max(ts_col).alias("ts"))
    if mode == "incrementing":
        return df.agg(F.max(id_col).alias("id"))
    if mode == "timestamp+incrementing":
        return df.agg(F.max(F.struct(F.col(ts_col).alias("ts"), F.col(id_col).alias("id"))).alias("last")).select("last.*")
    raise ValueError(f"mode {mode} keeps no offset")


def poll_watermark(
    df: DataFrame,
    ts_col: str,
    partition_cols: list[str],
    watermark=None,
    arrival: list[str] | None = None,
    key_col: str | None = None,
    limit: int = 0,
) -> DataFrame:
    """Rows above the watermark with ``offset_ts``, the running maximum of the time seen so far per partition.

    ``arrival`` gives the order rows arrive in; without it they are read in time
    order, where the running maximum is the row's own time. ``key`` is the key
    column, else ``id``, else the first column.
    """
    if watermark is not None:
        df = df.filter(F.col(ts_col) > F.lit(watermark))
    key = key_col or ("id" if "id" in df.columns else df.columns[0])
    df = df.withColumn("key", F.col(key).cast("string"))
    if limit > 0:
        df = df.orderBy(*(arrival or [ts_col])).limit(limit)
    if arrival is None:
        return df.withColumn("offset_ts", F.col(ts_col))
    return running_max(df, partition_cols, arrival, ts_col, "offset_ts")


def shards_since(
    df: DataFrame, offsets: DataFrame | None = None, shard: str = "shard", seq: str = "seq", limit: int = 0
) -> DataFrame:
    """Records of every shard after its stored position; shards without one are read from the start.

    ``offsets`` has (shard, last_seq). The cap is shared by all shards, which are
    drained in order, so that nothing is skipped.
    """
    if offsets is not None:
        df = df.join(offsets, shard, "left").filter(F.col("last_seq").isNull() | (F.col(seq) > F.col("last_seq"))).drop("last_seq")
    return df.orderBy(shard, seq).limit(limit) if limit > 0 else df


def shard_positions(read: DataFrame, offsets: DataFrame | None = None, shard: str = "shard", seq: str = "seq") -> DataFrame:
    """The position to store per shard; finished shards keep theirs, so they are never read again."""
    fresh = read.groupBy(shard).agg(F.max(seq).alias("last_seq"))
    if offsets is None:
        return fresh
    return fresh.unionByName(offsets).groupBy(shard).agg(F.max("last_seq").alias("last_seq"))
