"""The whole flow: batches of JSON records to conforming records by the cheapest capable route."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import discovery, privacy, profiling, reuse
from ..operators.accounting import call_cost
from ..operators.batching import arrival_batches, assign_batches, numbered_batches, split_batches
from ..operators.contract import Contract, split, to_dead_letter, validate
from ..operators.model import ModelClient, build_prompts, complete, embed, numbered_results, path_exists
from ..operators.rules import apply_patterns
from ..operators.staging import Shelf, materialise
from ..streaming import runner
from .config import FlowConfig

_CACHE = "cache_id string, content_key string, embedding array<float>, output string, created_at timestamp"
_KEYS = ["batch_id", "ordinal"]
_LOG = ["request_hash", "batch_id", "records", "answer_model", "input_tokens", "output_tokens"]
_LOG += ["cache_create_tokens", "cache_read_tokens", "attempts", "latency_ms", "call_error"]


@dataclass
class FlowResult:
    """``good`` and ``quarantine`` records, the ``calls`` made in this run, and the specs found invalid.

    ``source`` holds all columns of the input record but its value: offsets, metadata, headers,
    whatever it came with. Outputs beyond a batch's inputs have none.
    """

    good: DataFrame
    quarantine: DataFrame
    calls: DataFrame | None
    invalid_specs: DataFrame | None


class Pipeline:
    """Composes the operators in a fixed order.

    compiled mapping -> mask -> reuse of equal (or similar) inputs -> route ->
    rules or model -> unmask -> contract -> redo of missing outputs one by one.
    Every input record ends either in ``good`` or in ``quarantine``, with its source columns.
    """

    def __init__(self, config: FlowConfig, client: ModelClient | None = None, embedder=None):
        self.config, self.client, self.embedder = config, client, embedder
        self.contract = Contract.parse(config.contract)

    @classmethod
    def with_discovered_contract(cls, config: FlowConfig, df: DataFrame, client: ModelClient | None = None, embedder=None) -> Pipeline:
        """A flow whose contract is learnt from records that are right: the fields of ``df``, their types, and which all have."""
        found = discovery.contract_of(discovery.nested_schema(discovery.discover_paths(df)))
        return cls(replace(config, contract=json.dumps(found)), client, embedder)

    # ------------------------------------------------------------------ batch

    def transform(self, df: DataFrame) -> FlowResult:
        """``df`` has key, value (JSON text) and the order columns of the batch options."""
        c = self.config
        shelf = Shelf(df.sparkSession)
        carried = [F.col(f"`{x}`") for x in df.columns if x != "value"]
        packed = df.select("key", "value", *[F.col(f"`{x}`") for x in c.batches.order if x not in ("key", "value")],
                           F.struct(*carried).alias("source"))
        batched = self._batched(packed).select(*_KEYS, "key", "value", "source")
        trusted: list[DataFrame] = []  # already checked against the contract
        unchecked: list[DataFrame] = []
        invalid = None

        specs = self._specs(df.sparkSession)
        if specs is not None:
            batched = profiling.with_fingerprint(batched, c.contract, c.fingerprint_mode)
        rows = batched = shelf.put(batched)
        if specs is not None:
            done, rows, invalid = reuse.apply_compiled(rows, specs, self.contract)
            trusted.append(self._finish(shelf.put(done.select(*_KEYS, "key", "value", "source")), "compiled"))

        if c.router.enabled:
            rows = profiling.route(rows, c.router.models, c.router.patterns, c.router.granularity)
        else:
            rows = rows.withColumns({"tier": F.lit(2), "model": F.lit(c.router.default_model), "reason": F.lit("")})
        rows = rows.select(*_KEYS, "key", "value", "source", "tier", "model")
        if c.router.enabled or c.reuse.cache_path is not None:
            # Several branches read the routed records: they are written once.
            rows = shelf.put(rows)
            shelf.take_down(batched)
            batched = rows
        trusted.append(self._finish(shelf.put(rows.filter("value is null")), "empty"))
        rows = rows.filter("value is not null").withColumn("_raw", F.col("value"))

        if c.reuse.cache_path is not None and path_exists(df.sparkSession, c.reuse.cache_path):
            cached, rows = self._from_cache(privacy.mask(rows, c.masking.fields, c.masking.patterns), shelf)
            unchecked.append(self._finish(cached, "cache"))

        if c.router.enabled and c.router.patterns:
            # Rules run in place, on the record as it came.
            plain = rows.filter("tier = 0").withColumn("value", F.col("_raw"))
            simple = shelf.put(apply_patterns(plain, c.router.patterns))
            unchecked.append(self._finish(simple.filter("handled"), "rules", restore=False))
            left = simple.filter("not handled").drop("handled").withColumn("model", F.lit(c.router.default_model))
            rows = rows.filter("tier > 0").unionByName(left, allowMissingColumns=True)
        rows = rows.withColumn("value", F.col("_raw")).drop("_raw", "mask_map")
        rows = privacy.mask(rows, c.masking.fields, c.masking.patterns)

        calls, lost = None, []
        if self.client is not None:
            keyed = shelf.put(rows.withColumn("content_key", self._work_key()))
            # All that is left to do reads the masked records.
            shelf.take_down(batched)
            answered, surplus, missing, calls = self._by_model(keyed, shelf)
            # Masked answers are checked once more with their originals in place.
            (unchecked if c.masking.enabled else trusted).append(self._finish(answered, "model"))
            trusted.append(surplus)
            lost.append(missing)
            self._store(answered, keyed)
        else:
            unsent = privacy.unmask(rows, enabled=c.masking.enabled)
            lost.append(unsent.select(*_KEYS, "key", "value", "source", F.array(F.lit("no model client")).alias("errors")))

        good, bad = self._checked(unchecked, shelf)
        for part in trusted:
            good = part if good is None else good.unionByName(part)
        for part in bad:
            lost.append(part)
        rejected = lost[0]
        for part in lost[1:]:
            rejected = rejected.unionByName(part)
        good = good.select(*_KEYS, "key", "value", "route", "source")
        quarantine = to_dead_letter(rejected.select(*_KEYS, "key", "value", "errors", "source"), "transform")
        return FlowResult(good, quarantine, calls, invalid)

    def _batched(self, df: DataFrame) -> DataFrame:
        order, size = list(self.config.batches.order), self.config.batches.size
        return assign_batches(df, order, size) if order else arrival_batches(df, size)

    def _checked(self, parts: list[DataFrame], shelf: Shelf) -> tuple[DataFrame | None, list[DataFrame]]:
        if not parts:
            return None, []
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        # Read twice below, computed once.
        good, bad = split(shelf.put(validate(whole, self.contract)))
        return good, [bad.select(*_KEYS, "key", "value", "source", "errors")]

    def explain_routes(self, df: DataFrame) -> DataFrame:
        """One row per batch: its profile and the tier it would take."""
        c = self.config
        batched = self._batched(df)
        return profiling.with_tier(profiling.batch_profile(batched), c.router.models, c.router.patterns)

    def compile(self, df: DataFrame, order: str = "ordinal") -> DataFrame:
        """Ask for specs of structures seen for the first time and append them to the spec table."""
        c = self.config
        rows = profiling.with_fingerprint(df, c.contract, c.fingerprint_mode)
        known = self._specs(df.sparkSession)
        # The table read above is appended to below, so the new specs are computed first.
        fresh = materialise(
            reuse.compile_specs(
                rows,
                self.client,
                self.contract,
                order,
                known,
                c.router.default_model,
                shown=lambda d: privacy.mask(d, c.masking.fields, c.masking.patterns).drop("mask_map"),
                wait_seconds=c.calls.wait_seconds,
            )
        )
        fresh.write.mode("append").parquet(c.reuse.spec_path)
        return fresh

    # -------------------------------------------------------------- streaming

    def transform_stream(self, sdf: DataFrame, work: Callable[[FlowResult, int], None]) -> Callable[[DataFrame, int], None]:
        """The micro-batch function; spec and cache tables are read anew for each micro-batch."""

        def one(batch: DataFrame, batch_id: int) -> None:
            # Transform reads its input several times; the source is read once.
            held = batch.persist()
            try:
                if not held.isEmpty():
                    work(self.transform(held), batch_id)
                    if self.config.reuse.spec_path and self.client is not None:
                        self.compile(held, self.config.batches.order[0])  # for later micro-batches
            finally:
                held.unpersist()

        return one

    def start(
        self, sdf: DataFrame, sink: Callable[[FlowResult, int], None], checkpoint: str, interval: str | None = None
    ) -> StreamingQuery:
        """Run over a stream; offsets are committed after the sink has returned."""
        return runner.run(sdf, self.transform_stream(sdf, sink), checkpoint, interval)

    # --------------------------------------------------------------- internals

    def _specs(self, spark: SparkSession) -> DataFrame | None:
        path = self.config.reuse.spec_path
        if path is None or not path_exists(spark, path):
            return None
        log = spark.read.schema(reuse.SPEC_COLUMNS).parquet(path)
        return reuse.live_specs(log, self.config.reuse.spec_ttl_seconds)

    def _work_key(self):
        """Equal masked text under an equal contract and prompt is equal work."""
        return reuse.content_key(
            F.concat_ws("\u0001", F.col("value"), F.lit(self.config.contract), F.lit(self.config.system_prompt))
        )

    def _from_cache(self, rows: DataFrame, shelf: Shelf) -> tuple[DataFrame, DataFrame]:
        """(records with a stored output of equal or similar masked text, the others)."""
        c, spark = self.config.reuse, rows.sparkSession
        cache = reuse.live_entries(spark.read.schema(_CACHE).parquet(c.cache_path), c.cache_ttl_seconds)
        newest = cache.groupBy("content_key").agg(F.max_by("output", "created_at").alias("output"))
        looked = rows.withColumn("content_key", self._work_key()).join(newest, "content_key", "left").drop("content_key")
        looked = shelf.put(looked)
        hit = looked.filter("output is not null").withColumn("value", F.col("output")).drop("output")
        miss = looked.filter("output is null").drop("output")
        if c.similarity is not None and self.embedder is not None:
            asked = embed(miss, self.embedder, "value").withColumn("query_id", F.concat_ws(":", *_KEYS))
            found = reuse.cache_lookup(asked, cache.filter("embedding is not null"), c.similarity)
            found = shelf.put(found.drop("embedding", "query_id", "similarity", "cache_id", "age_seconds"))
            near = found.filter("hit").withColumn("value", F.col("output")).drop("hit", "output")
            hit, miss = hit.unionByName(near), found.filter("not hit").drop("hit", "output")
        return hit, miss

    def _by_model(self, keyed: DataFrame, shelf: Shelf) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """(answers joined to their inputs, outputs beyond the inputs, inputs without a valid answer, the calls made)."""
        c = self.config
        options = {
            "log_path": c.reuse.call_log_path,
            "max_retries": c.calls.max_retries,
            "wait_seconds": c.calls.wait_seconds,
            "calls_per_second": c.calls.calls_per_second,
            "at_once": c.calls.at_once,
            "time_limit": c.calls.time_limit,
            "options": c.calls.request_options,
        }
        work = ["content_key", *_KEYS, "model"]
        # Which records are asked about, by their numbers alone; their texts are read again for the prompts.
        staged, unit = self._numbered(keyed.select(*work))
        staged = shelf.put(staged)
        first = self._ask(self._numbered(keyed.select(*work, "value"))[0], unit, options, shelf)
        found = shelf.put(self._placed(staged, self._match(first, unit), unit))
        ok = found.filter("origin is not null")
        extra = found.filter("ordinal is null")
        source = F.lit(None).cast(keyed.schema["source"].dataType).alias("source")
        surplus = extra.select(
            "batch_id", F.lit(None).cast("int").alias("ordinal"), F.col("own_key").alias("key"), "value", source, F.lit("model").alias("route")
        )
        log_rows, outputs = [first], ok
        # Only inputs without a good answer are asked again, one by one and still masked.
        missing = shelf.put(staged.join(ok.select(*unit, "ordinal"), [*unit, "ordinal"], "left_anti"))
        failures = None
        if not missing.isEmpty():
            single = missing.withColumn("_of", F.col("ordinal")).withColumn("ordinal", F.lit(0))
            redo_unit = [*unit, "_of"]
            texts = keyed.select("batch_id", F.col("ordinal").alias("origin"), "value")
            second = self._ask(single.join(texts, ["batch_id", "origin"]), redo_unit, options, shelf)
            redone = shelf.put(self._placed(single, self._match(second, redo_unit), redo_unit).filter("origin is not null"))
            outputs = ok.unionByName(redone, allowMissingColumns=True)
            failures = single.join(second.select(*redo_unit, "call_error"), redo_unit)
            log_rows.append(second)

        # A call counts in the run that made it, once, however many batches share its answer.
        calls = log_rows[0].filter("made_now").select(*_LOG)
        for part in log_rows[1:]:
            calls = calls.unionByName(part.filter("made_now").select(*_LOG))
        calls = calls.dropDuplicates(["request_hash"])
        calls = shelf.put(call_cost(calls.withColumnRenamed("answer_model", "model"), c.prices))

        # Outputs go back to every record of equal work (or to the one record asked about).
        back = ["content_key"] if c.reuse.merge_equal else ["batch_id", "origin"]
        if failures is not None:
            failures = shelf.put(failures.groupBy(*back).agg(F.max("call_error").alias("call_error")))
        shelf.take_down(*log_rows)
        outputs = outputs.select(*back, F.col("value").alias("output"), "own_key")
        source = keyed.withColumn("origin", F.col("ordinal")).select(
            "content_key", *_KEYS, "origin", "key", "value", "source", "mask_map"
        )
        answered = (
            source.join(outputs, back)
            .withColumns({"value": F.col("output"), "key": F.coalesce("own_key", "key")})
            .select(*_KEYS, "key", "value", "source", "mask_map", "content_key")
        )
        lost = source.join(outputs.select(*back), back, "left_anti")
        if failures is not None:
            lost = lost.join(failures, back, "left")
        else:
            lost = lost.withColumn("call_error", F.lit(None).cast("string"))
        lost = lost.withColumn("errors", F.array(F.coalesce("call_error", F.lit("no valid output"))))
        lost = privacy.unmask(lost, enabled=c.masking.enabled)
        return answered, surplus, lost.select(*_KEYS, "key", "value", "source", "errors"), calls

    def _numbered(self, rows: DataFrame) -> tuple[DataFrame, list[str]]:
        """The records to ask about, numbered within their call (``origin`` is their number in the batch), and the columns that name a call."""
        c = self.config
        asked = self._representatives(rows) if c.reuse.merge_equal else rows
        # Rows left in a batch get consecutive numbers; a batch is small by definition.
        unit = ["batch_id", "model"]
        renumber = F.row_number().over(Window.partitionBy(*unit).orderBy("ordinal")) - 1
        staged = asked.withColumn("origin", F.col("ordinal")).withColumn("ordinal", renumber)
        if c.batches.parallel_calls > 1:
            marked = staged.withColumn("_unit", F.concat_ws("|", *unit))
            marked = split_batches(marked, c.batches.parallel_calls, "_unit").drop("_unit")
            again = F.row_number().over(Window.partitionBy(*unit, "sub_batch").orderBy("origin")) - 1
            staged = marked.withColumn("ordinal", again)
            unit = [*unit, "sub_batch"]
        return staged, unit

    def _representatives(self, rows: DataFrame) -> DataFrame:
        """One record per distinct work, the first in batch order; merged before the shuffle, so copies cost nothing."""
        names = [c for c in rows.columns if c != "content_key"]
        first = F.min_by(F.struct(*names), F.struct(*_KEYS)).alias("_first")
        return rows.groupBy("content_key").agg(first).select("content_key", "_first.*")

    def _ask(self, staged: DataFrame, unit: list[str], options: dict, shelf: Shelf) -> DataFrame:
        """The answer to each call, without the prompt."""
        batches = shelf.put(numbered_batches(staged, unit))
        answers = []
        prompts = build_prompts(batches, self.config.system_prompt, self.contract)
        answered = complete(prompts, self.client, keep=lambda df: answers.append(shelf.put(df)) or answers[0], **options)
        told = shelf.put(answered.select(*dict.fromkeys([*unit, *_LOG, "content", "made_now"])))
        shelf.take_down(batches, *answers)
        return told

    def _match(self, answers: DataFrame, unit: list[str]) -> DataFrame:
        """Conforming elements of the answers, with the number of their input."""
        usable = answers.filter("content is not null").select(*unit, "records", "content")
        # A placeholder cannot be compared with an enum; that check follows on the restored record.
        contract = replace(self.contract, enums={}) if self.config.masking.enabled else self.contract
        good, _ = split(numbered_results(usable, unit, contract))
        return good

    def _placed(self, staged: DataFrame, found: DataFrame, unit: list[str]) -> DataFrame:
        """Elements with ``origin`` and ``content_key`` of their input, NULL for those beyond the inputs."""
        return found.join(staged.select(*unit, "ordinal", "origin", "content_key"), [*unit, "ordinal"], "left")

    def _store(self, answered: DataFrame, asked: DataFrame) -> None:
        """Keep masked outputs by masked input: no original value reaches the cache."""
        path = self.config.reuse.cache_path
        if path is None:
            return
        once = answered.groupBy("content_key").agg(F.min_by("value", F.struct(*_KEYS)).alias("output"))
        if self.config.reuse.similarity is not None and self.embedder is not None:
            inputs = asked.select("value", "content_key").dropDuplicates(["content_key"])
            once = embed(once.join(inputs, "content_key"), self.embedder, "value")
        else:
            once = once.withColumn("embedding", F.lit(None).cast("array<float>"))
        once.select(
            F.col("content_key").alias("cache_id"),
            "content_key",
            "embedding",
            "output",
            F.current_timestamp().alias("created_at"),
        ).write.mode("append").parquet(path)

    def _finish(self, df: DataFrame, route: str, restore: bool = True) -> DataFrame:
        masked = restore and "mask_map" in df.columns
        out = privacy.unmask(df, enabled=self.config.masking.restore) if masked else df
        return out.select(*_KEYS, "key", "value", "source", F.lit(route).alias("route"))


__all__ = ["FlowConfig", "FlowResult", "Pipeline"]
