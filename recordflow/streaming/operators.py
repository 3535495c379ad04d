"""Stateful and stateless stream operators."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType


def dedup_stream(sdf: DataFrame, ts_col: str, delay: str, partition: list[str], offset: str) -> DataFrame:
    """One record per source position, remembered for ``delay`` of event time."""
    return sdf.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([*partition, offset])


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# What a batch says of a record, before the record's own columns.
HEAD = [
    StructField("lane", IntegerType()),
    StructField("flush_no", LongType()),
    StructField("ordinal", IntegerType()),
    StructField("reason", StringType()),
]


class _Flush(StatefulProcessor):
    """A lane's waiting records as list state, a timer for the oldest of them."""

    def __init__(self, schema: StructType, size: int, max_wait_ms: int):
        self.size, self.max_wait_ms = size, max_wait_ms
        self.batched = Row(*[f.name for f in HEAD], *schema.names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Records as pickled values, so that state holds columns of any type.
        self.held = handle.getListState("held", "record binary")
        # Records waiting, batches flushed so far, when the first one waiting came.
        self.facts = handle.getValueState("facts", "waiting bigint, flushes bigint, since bigint")

    def _waiting(self) -> list[tuple]:
        return [pickle.loads(record) for (record,) in self.held.get()]

    def _flushed(self, lane: int, flush: int, rows: list, reason: str) -> Iterator[Row]:
        for i, row in enumerate(rows):
            yield self.batched(lane, flush, i, reason, *row)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (lane,) = key
        waiting, flushes, since = self.facts.get() or (0, 0, -1)
        now, before, fresh = timerValues.getCurrentProcessingTimeInMs(), waiting, []
        for row in rows:
            fresh.append(tuple(row)[1:])
            if waiting + len(fresh) == self.size:
                batch = [*self._waiting(), *fresh] if waiting else fresh
                yield from self._flushed(lane, flushes, batch, "size")
                if waiting:
                    self.held.clear()
                waiting, flushes, fresh = 0, flushes + 1, []
        if fresh:
            self.held.appendList([(pickle.dumps(r, protocol=5),) for r in fresh])
        if before and not waiting:
            self.handle.deleteTimer(since + self.max_wait_ms)
        if fresh and not waiting:
            since = now
            self.handle.registerTimer(since + self.max_wait_ms)
        self.facts.update((waiting + len(fresh), flushes, since))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        (lane,) = key
        waiting, flushes, since = self.facts.get() or (0, 0, -1)
        if waiting:
            yield from self._flushed(lane, flushes, self._waiting(), "age")
            self.held.clear()
            self.facts.update((0, flushes + 1, since))

    def close(self) -> None:
        """Nothing is held outside the state."""


def flush_by_size_or_age(sdf: DataFrame, size: int, max_wait_ms: int, lanes: int | None = None) -> DataFrame:
    """Batches of a stream: flushed at ``size`` records, or ``max_wait_ms`` after the first waiting one.

    Returns lane, flush_no, ordinal, reason (size, age) and every column of the record, whatever its
    type, so that a batch can be traced to its source; columns of a record with these names are not allowed.
    Records are spread over lanes by a hash of the whole record, so neither a hot key nor a
    hot source overloads one lane; equal records share a lane. Each lane holds less
    than one batch between triggers. By default there are as many lanes as shuffle partitions. Where a
    trigger interval is fine enough an age limit, batch the micro-batches with ``arrival_batches`` instead: that needs no state.

    State and timers need the RocksDB state store, which is set for the session.
    """
    own = {f.name for f in HEAD} & set(sdf.columns)
    if own:
        raise ValueError(f"columns named as those of a batch: {sorted(own)}")
    spark = sdf.sparkSession
    lanes = lanes or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sdf.columns]))
    return (
        sdf.select(F.pmod(F.xxhash64(record), F.lit(lanes)).cast("int").alias("lane"), *[F.col(f"`{c}`") for c in sdf.columns])
        .groupBy("lane")
        .transformWithState(
            _Flush(sdf.schema, size, max_wait_ms), StructType([*HEAD, *sdf.schema.fields]), "Append", "ProcessingTime"
        )
    )
