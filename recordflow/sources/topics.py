"""Streaming reads of topics and of sharded logs landed as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.records import text_map, topic_envelope


def from_kafka(
    spark: SparkSession,
    servers: str,
    topics: list[str] | None = None,
    pattern: str | None = None,
    starting: str = "earliest",
    consumer: dict[str, str] | None = None,
    stream: bool = True,
    **options,
) -> DataFrame:
    """Records of topics given by name or by pattern. Needs Spark's Kafka package on the class path.

    ``consumer`` settings are passed through; ``maxOffsetsPerTrigger`` and
    ``minPartitions`` are the knobs for large backlogs and hot partitions.
    """
    if bool(topics) == bool(pattern):
        raise ValueError("give either topics or a pattern")
    reader = (spark.readStream if stream else spark.read).format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", ",".join(topics)) if topics else reader.option("subscribePattern", pattern)
    reader = reader.option("startingOffsets", starting).option("includeHeaders", "true")
    for name, setting in {**{f"kafka.{k}": v for k, v in (consumer or {}).items()}, **options}.items():
        reader = reader.option(name, setting)
    return topic_envelope(reader.load())


def read_shard_log(
    spark: SparkSession,
    path: str,
    schema: str,
    shard: str = "shard",
    seq: str = "seq",
    max_files: int | None = None,
    start_after: dict[str, int] | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """A log landed as ``<path>/shard=<id>/<files>``, as a stream.

    New shards appear by themselves, finished ones are not read again, and
    ``max_files`` caps a micro-batch without losing anything: the file source
    keeps what was read in the checkpoint. One shard may hold any number of
    files, so a hot shard is read by many tasks. ``start_after`` skips what an
    earlier consumer has already seen.
    """
    reader = spark.readStream.format(file_format).schema(schema).option("basePath", path)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.load(f"{path}/{shard}=*")
    if start_after:
        seen = F.create_map(*[F.lit(x) for pair in start_after.items() for x in pair])
        df = df.filter(F.col(seq) > F.coalesce(F.element_at(seen, F.col(shard).cast("string")), F.lit(-1)))
    return df.withColumns(
        {
            "src_partition": text_map({"shard": F.col(shard)}),
            "src_offset": text_map({"seq": F.col(seq)}),
        }
    )
