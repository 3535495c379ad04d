"""Running a batch function over a stream with replay-safe writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def run(
    sdf: DataFrame,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Poll, hand over each micro-batch, and commit its offsets only after ``work`` has returned.

    Without an interval everything available is processed and the query ends.
    """
    writer = sdf.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def write_once(df: DataFrame, path: str, batch_id: int) -> None:
    """Append-only output: each micro-batch owns one folder, so that a replay replaces its own output."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


class VersionedTable:
    """A keyed table of files: each merge writes a new version, then a marker makes it current.

    A replayed micro-batch starts again from the version before its own.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _versions(self) -> list[int]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        numbers = [int(n.split("=")[1]) for n in names if n.startswith("version=")]
        # Spark writes _SUCCESS last: a version without it never finished.
        return sorted(
            n
            for n in numbers
            if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/version={n}/_SUCCESS"))
        )

    def before(self, version: int | None = None) -> DataFrame | None:
        done = [n for n in self._versions() if version is None or n < version]
        return self.spark.read.parquet(f"{self.path}/version={done[-1]}") if done else None

    current = before

    def publish(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/version={version}")
