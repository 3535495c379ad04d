"""Compiled specs kept between micro-batches: a structure is compiled once, and again when its spec expires or fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reuse
from ..operators.contract import Contract
from ..operators.model import path_exists
from ..operators.staging import materialise

_DROPPED = "fingerprint string, invalidated_at timestamp"


class SpecTable:
    """Specs and their invalidations by fingerprint, in one folder per micro-batch.

    A micro-batch reads what batches before it have left, so that one that runs
    again after a failure overwrites its own folders and comes to the same state. The
    state has one row per structure and compilation, not per record: records are only
    reduced to three samples per structure before the shuffle, whatever share of them a structure has.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _before(self, kind: str, schema: str, batch_id: int) -> DataFrame:
        # The empty frame stands for a folder that no batch has written yet.
        empty = self.spark.createDataFrame([], f"{schema}, batch long")
        if not path_exists(self.spark, f"{self.path}/{kind}"):
            return empty.drop("batch")
        stored = self.spark.read.schema(f"{schema}, batch long").parquet(f"{self.path}/{kind}")
        return stored.filter(F.col("batch") < batch_id).drop("batch")

    def live(self, batch_id: int, ttl_seconds: int = -1, now: Column | None = None) -> DataFrame:
        """The specs that batch ``batch_id`` starts with."""
        log = self._before("specs", reuse.SPEC_COLUMNS, batch_id)
        return reuse.live_specs(log, ttl_seconds, now, self._before("dropped", _DROPPED, batch_id))

    def compiled(self) -> DataFrame:
        """Every spec ever compiled, with the ``batch`` that did."""
        return self.spark.read.schema(f"{reuse.SPEC_COLUMNS}, batch long").parquet(f"{self.path}/specs")

    def step(
        self,
        rows: DataFrame,
        batch_id: int,
        client,
        contract: Contract,
        order: str,
        ttl_seconds: int = -1,
        now: Column | None = None,
        **call_options,
    ) -> tuple[DataFrame, DataFrame]:
        """Compile what is new, run the records and note failed specs: (done, rest).

        ``rows`` carry ``fingerprint`` and ``value``. ``now`` is the time of the batch (default: the clock), by which
        specs expire ``ttl_seconds`` after they were made (-1: never). The records of a spec that fails in this batch
        are in ``rest``, and its structure is compiled again by the next batch that holds it. An
        empty batch changes nothing; null values pass as done.
        """
        at = now if now is not None else F.current_timestamp()
        known = materialise(self.live(batch_id, ttl_seconds, now))
        fresh = reuse.compile_specs(rows, client, contract, order, known, **call_options)
        folder = f"{self.path}/specs/batch={batch_id}"
        fresh.withColumn("created_at", at).select(*known.columns).write.mode("overwrite").parquet(folder)
        current = known.unionByName(self.spark.read.schema(reuse.SPEC_COLUMNS).parquet(folder))
        done, rest, invalid = reuse.apply_compiled(rows, current, contract)
        dropped = invalid.select("fingerprint", at.cast("timestamp").alias("invalidated_at"))
        dropped.write.mode("overwrite").parquet(f"{self.path}/dropped/batch={batch_id}")
        return done, rest

