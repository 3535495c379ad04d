"""Sending records out of a batch or a stream, with the rows that failed kept as dead letters.

Tasks send runs of records and try failed ones again; what still fails goes, with its
error, into a file beside the dead-letter table. The files of a job appear in the table when
Spark commits the job, so that a lost or repeated task leaves no second copy; a
micro-batch that runs again replaces its own. One bad row stops neither its task nor
the stream. Rows are sent at least once.
"""

from __future__ import annotations

import datetime
import random
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from ..sources.recordlog import file_system
from .model import CallFailed
from .sinks import PUT_LIMIT

# What a dead letter says beside the columns of its row.
LETTER = [
    StructField("error_message", StringType()),
    StructField("error_class", StringType()),
    StructField("error_ts", TimestampType()),
    StructField("stage", StringType()),
    StructField("attempts", IntegerType()),
]

Failures = Iterable[int] | Mapping[int, Exception | None]


@dataclass(frozen=True)
class Delivery:
    """How rows are sent. ``sender`` gets a list of rows as dicts and returns the places of those that failed,
    each with its exception if it has one; if it raises, the whole run has failed."""

    sender: Callable[[list[dict]], Failures]
    size: int = PUT_LIMIT
    retries: int = 3
    wait_seconds: float = 0.1
    stage: str = "deliver"

    def _attempt(self, rows: list[dict]) -> dict[int, Exception | None]:
        try:
            failed = self.sender(rows)
        except Exception as error:  # noqa: BLE001 whatever the sender raises is an answer about its rows
            return dict.fromkeys(range(len(rows)), error)
        return dict(failed) if isinstance(failed, Mapping) else dict.fromkeys(failed)

    def send(self, rows: list[dict]) -> list[tuple[int, Exception | None, int]]:
        """Place, error and attempts of the rows of a run that could not be sent."""
        waiting, out = list(range(len(rows))), []
        for attempt in range(1, self.retries + 2):
            failed = {waiting[i]: e for i, e in self._attempt([rows[i] for i in waiting]).items()}
            again = [i for i, e in failed.items() if attempt <= self.retries and _may_pass(e)]
            out += [(i, e, attempt) for i, e in failed.items() if i not in set(again)]
            if not again:
                break
            waiting = sorted(again)
            asked = [e.retry_after for e in failed.values() if isinstance(e, CallFailed) and e.retry_after is not None]
            wait = max(asked) if asked else self.wait_seconds * 2 ** (attempt - 1)
            time.sleep(wait * (1 + 0.25 * random.random()))
        return sorted(out, key=lambda x: x[0])


def _may_pass(error: Exception | None) -> bool:
    """Whether another attempt may help: always, unless an answer says that the request itself is wrong."""
    return not isinstance(error, CallFailed) or error.status == 429 or error.status >= 500


def one_by_one(send_fn: Callable[[dict], None]) -> Callable[[list[dict]], dict[int, Exception]]:
    """A sender of runs from a function that sends one row, such as a rendered request, and raises when that fails."""

    def sender(rows: list[dict]) -> dict[int, Exception]:
        failed = {}
        for i, row in enumerate(rows):
            try:
                send_fn(row)
            except Exception as error:  # noqa: BLE001
                failed[i] = error
        return failed

    return sender


@dataclass
class _Sent(WriterCommitMessage):
    """What a task reports: where its dead letters lie, and counts. Rows do not pass through the driver."""

    part: int
    staged: str | None
    sent: int
    failed: int


class _Writer:
    """The common part of both writers; ``folder`` is the dead-letter table."""

    def __init__(self, delivery: Delivery, folder: str, schema: StructType):
        self.delivery, self.folder, self.schema = delivery, folder, schema
        self.job = uuid.uuid4().hex

    def write(self, iterator) -> _Sent:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        part, sent, dead, out = TaskContext.get().partitionId(), 0, 0, None
        files, root = file_system(self.folder)
        wanted = to_arrow_schema(StructType([*self.schema.fields, *LETTER]))
        staged = f"{root}/_staged/{uuid.uuid4().hex}.parquet"
        try:
            for batch in iterator:
                for at in range(0, batch.num_rows, self.delivery.size):
                    t = batch.slice(at, self.delivery.size)
                    failed = self.delivery.send(t.to_pylist())
                    sent += t.num_rows - len(failed)
                    if not failed:
                        continue
                    dead += len(failed)
                    if out is None:
                        files.create_dir(f"{root}/_staged", recursive=True)
                        out = pq.ParquetWriter(staged, wanted, filesystem=files)
                    now = datetime.datetime.now(datetime.UTC)
                    rows = t.take(pa.array([i for i, *_ in failed], pa.int64()))
                    said = [
                        pa.array([None if e is None else str(e) for _, e, _ in failed], pa.string()),
                        pa.array(["Refused" if e is None else type(e).__name__ for _, e, _ in failed], pa.string()),
                        pa.array([now] * len(failed), pa.timestamp("us", "UTC")),
                        pa.array([self.delivery.stage] * len(failed), pa.string()),
                        pa.array([n for *_, n in failed], pa.int32()),
                    ]
                    columns = [c.cast(k.type) for c, k in zip([*rows.columns, *said], wanted)]
                    out.write_batch(pa.RecordBatch.from_arrays(columns, schema=wanted))
        finally:
            if out is not None:
                out.close()
        return _Sent(part, staged if out is not None else None, sent, dead)

    def _publish(self, messages, batch: str, again: bool) -> None:
        from pyarrow import fs

        files, root = file_system(self.folder)
        files.create_dir(root, recursive=True)
        if again:  # a micro-batch that ran before: its letters are replaced
            for info in files.get_file_info(fs.FileSelector(root)):
                if info.base_name.startswith(f"{batch}-"):
                    files.delete_file(info.path)
        for m in messages:
            if m is not None and m.staged is not None:
                files.move(m.staged, f"{root}/{batch}-{m.part:06d}.parquet")

    def _drop(self, messages) -> None:
        files, _ = file_system(self.folder)
        for m in messages:
            if m is not None and m.staged is not None:
                files.delete_file(m.staged)


class _BatchWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self._publish(messages, f"job-{self.job}", False)

    def abort(self, messages) -> None:
        self._drop(messages)


class _StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self._publish(messages, f"batch-{batchId}", True)

    def abort(self, messages, batchId: int) -> None:
        self._drop(messages)


def _registered(spark: SparkSession, delivery: Delivery, folder: str) -> str:
    own = f"delivery_{uuid.uuid4().hex}"

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return own

        def writer(self, schema, overwrite):
            return _BatchWriter(delivery, folder, schema)

        def streamWriter(self, schema, overwrite):
            return _StreamWriter(delivery, folder, schema)

    spark.dataSource.register(Sink)
    return own


def deliver(df: DataFrame, delivery: Delivery, dead_letters: str) -> None:
    """Sends every row; those that fail after all attempts are added to the dead-letter table in that folder.

    A row with a wrong request (status 4xx but 429) is not tried again. An empty table sends nothing.

    Scale: tasks send their partitions in runs of ``size``; a task holds one Arrow batch and writes its
    letters to a file, so any number of rows may fail.
    """
    df.write.format(_registered(df.sparkSession, delivery, dead_letters)).mode("append").save()


def deliver_stream(sdf: DataFrame, delivery: Delivery, dead_letters: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """``deliver`` for every micro-batch; without an interval all that is available is sent and the query ends.

    Each stream needs a dead-letter folder of its own, as the letters of a micro-batch bear its number.
    """
    writer = sdf.writeStream.format(_registered(sdf.sparkSession, delivery, dead_letters)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def read_dead_letters(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The table of rows that failed: the columns of the rows (``schema``), error_message, error_class, error_ts, stage, attempts."""
    files, root = file_system(folder)
    files.create_dir(root, recursive=True)
    return spark.read.schema(StructType([*schema.fields, *LETTER])).parquet(folder)
