"""Materialisation and ordered chunks, shared by operators that need a global or per-key order.

An ordered scan never puts one key, or the whole table, into one task: rows are
range-partitioned on (key..., order...), so a key holding a third of all rows is
spread over many ranges. Per-range summaries (one row per key and range) carry
the state from range to range.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """withColumns whose results are computed once, however often later steps use them.

    The optimizer would otherwise copy these expressions into every filter and
    projection above, and parse the same JSON again for each use. Passing the
    values through a one-element generator keeps them apart, inside one stage.
    """
    named = {f"_once_{i}": c for i, c in enumerate(columns.values())}
    kept = [F.col(c) for c in df.columns if c not in columns]
    held = F.array(F.struct(*[F.col(n).alias(c) for n, c in zip(named, columns)]))
    order = [c for c in df.columns] + [c for c in columns if c not in df.columns]
    return df.withColumns(named).select(*kept, F.inline(held)).select(*order)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only in local mode with none set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        current = tempfile.mkdtemp(prefix="recordflow-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def materialise(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder; survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


# Types that come back from Parquet as they were.
_PLAIN = (T.StringType, T.BinaryType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.VariantType)


def _fits_parquet(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        names = {f.name.lower() for f in kind.fields}
        return 0 < len(names) == len(kind.fields) and all(_fits_parquet(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _fits_parquet(kind.elementType)
    if isinstance(kind, T.MapType):
        return _fits_parquet(kind.keyType) and _fits_parquet(kind.valueType)
    return isinstance(kind, _PLAIN)


class Shelf:
    """Frames stored in the checkpoint folder, each until it is taken down; for rows with large texts.

    ``materialise`` writes whole rows uncompressed, and they and the shuffles before them stay on disk until the driver
    happens to collect its garbage. Here rows are compressed columns, of which a later step reads those
    it uses, and shuffles go as soon as their rows are stored.
    """

    TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    # Rows decoded at a time are those of one row group at most.
    GROUP_BYTES = 16 << 20

    def __init__(self, spark: SparkSession):
        self.spark, self._folders = spark, []

    def put(self, df: DataFrame) -> DataFrame:
        """The frame as stored: computed once."""
        folder = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/recordflow-shelf-{uuid.uuid4().hex}"
        before = self.spark.conf.get(self.TIDY, None)
        self.spark.conf.set(self.TIDY, "true")
        try:
            if not _fits_parquet(df.schema):
                return materialise(df.select("*"))
            df.write.options(**{"compression": "zstd", "parquet.block.size": self.GROUP_BYTES}).parquet(folder)
        finally:
            self.spark.conf.unset(self.TIDY) if before is None else self.spark.conf.set(self.TIDY, before)
        stored = self.spark.read.schema(df.schema).parquet(folder)
        self._folders.append((stored, folder))
        return stored

    def take_down(self, *frames: DataFrame) -> None:
        """Delete what was stored; no frame that is still to be computed may read it."""
        for _, folder in [x for x in self._folders if any(x[0] is f for f in frames)]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self._folders = [x for x in self._folders if not any(x[0] is f for f in frames)]


RANGE_BYTES = 64 << 20


def source_bytes(df: DataFrame) -> tuple[int, bool]:
    """Bytes of the relations a plan reads, as far as their sizes are known, and whether all are."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = [n for n in sizes if n < 1 << 60]
    return sum(known), len(known) == len(sizes)


def spread_count(df: DataFrame) -> int:
    """Partitions for a redistribution: about RANGE_BYTES each of what the plan reads, at least one per core.

    Where sizes are unknown, at least ``spark.sql.shuffle.partitions``.
    """
    spark = df.sparkSession
    size, known = source_bytes(df)
    least = spark.sparkContext.defaultParallelism
    if not known:
        least = max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(least, size // RANGE_BYTES + 1)


def ordered_chunks(df: DataFrame, order: list[str], chunk: str = "_chunk", rank: str = "_rank") -> DataFrame:
    """Rows tagged with the number of their range in the total order of ``order``, and their place within it.

    One shuffle: the ids given to sorted partitions hold both numbers. Range
    bounds come from a sample, so the tagged rows are materialised: the two
    passes of a scan must see the same ranges.
    """
    columns = [F.col(c) for c in order]
    ranged = df.repartitionByRange(spread_count(df), *columns).sortWithinPartitions(*columns)
    tagged = materialise(ranged.withColumn("_id", F.monotonically_increasing_id()))
    return tagged.withColumns(
        {chunk: F.shiftright("_id", 33).cast("int"), rank: F.col("_id").bitwiseAND((1 << 33) - 1)}
    ).drop("_id")


def positions(df: DataFrame, order: list[str], out: str = "_pos") -> DataFrame:
    """0-based position in the total order. ``order`` should end in a unique column."""
    chunked = ordered_chunks(df, order)
    # One row per range: a few thousand rows at most, whatever the table size.
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked.groupBy("_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    return (
        chunked.join(F.broadcast(offsets), "_chunk")
        .withColumn(out, F.col("_base") + F.col("_rank"))
        .drop("_chunk", "_base", "_rank")
    )


def running_max(df: DataFrame, by: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Running maximum of ``value`` per key in the given order."""
    chunked = ordered_chunks(df, by + order)
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        chunked.groupBy(*by, "_chunk")
        .agg(F.max(value).alias("_top"))
        .select(*by, "_chunk", F.max("_top").over(earlier).alias("_carried"))
    )
    inside = Window.partitionBy(*by, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        chunked.withColumn("_local", F.max(value).over(inside))
        .join(carried, [*by, "_chunk"])
        .withColumn(out, F.greatest("_carried", "_local"))
        .drop("_chunk", "_rank", "_local", "_carried")
    )


def fill_sequence(df: DataFrame, by: list[str], order: list[str], known: str, out: str, start: int = 0) -> DataFrame:
    """Last known id plus the number of rows since; rows that carry an id keep it."""
    chunked = ordered_chunks(df, by + order, rank="_at").drop("_at")
    inside = Window.partitionBy(*by, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    seen = chunked.withColumn("_rn", F.row_number().over(Window.partitionBy(*by, "_chunk").orderBy(*order)))
    given = F.struct(F.col(known).cast("bigint").alias("id"), F.col("_rn").alias("rn"))
    seen = seen.withColumn("_mark", F.last(F.when(F.col(known).isNotNull(), given), True).over(inside))
    # Summary per key and range: the last explicit id (if any) and the rows after it.
    last_id = F.max_by(F.col(known).cast("bigint"), F.when(F.col(known).isNotNull(), F.struct(*order)))
    summary = (
        seen.groupBy(*by, "_chunk")
        .agg(
            F.max(F.col("_mark")["rn"]).alias("_last_rn"),
            last_id.alias("_last_id"),
            F.count(F.lit(1)).alias("_n"),
        )
        .withColumn("_tail", F.col("_n") - F.coalesce(F.col("_last_rn"), F.lit(0)))
    )
    upto = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        summary.withColumn("_total", F.sum("_tail").over(upto))
        # Where a range holds an explicit id, the count restarts behind it.
        .withColumn(
            "_anchor",
            F.when(
                F.col("_last_id").isNotNull(),
                F.struct(
                    F.col("_last_id").alias("id"), (F.col("_total") - F.col("_tail")).alias("before")
                ),
            ),
        )
        .withColumn("_prev", F.last("_anchor", True).over(earlier))
        .withColumn("_total_before", F.coalesce(F.sum("_tail").over(earlier), F.lit(0)))
        .select(
            *by,
            "_chunk",
            (
                F.coalesce(F.col("_prev")["id"], F.lit(start))
                + F.col("_total_before")
                - F.coalesce(F.col("_prev")["before"], F.lit(0))
            ).alias("_base"),
        )
    )
    return (
        seen.join(carried, [*by, "_chunk"])
        .withColumn(
            out,
            F.when(F.col("_mark").isNotNull(), F.col("_mark")["id"] + F.col("_rn") - F.col("_mark")["rn"]).otherwise(
                F.col("_base") + F.col("_rn")
            ),
        )
        .drop("_chunk", "_rn", "_mark", "_base")
    )
