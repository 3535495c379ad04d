"""Reuse of earlier results: by equal text, by vector similarity, and by compiled mapping."""

from __future__ import annotations

import hashlib
import json
import math
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import variant as V
from .contract import Contract, error_list
from .mapping import expressed, is_mapping_spec, mapped
from .model import complete
from .staging import compute_once, ensure_checkpoint_dir, materialise, positions, spread_count

# ------------------------------------------------------------ exact-key reuse


def content_key(text: Column) -> Column:
    return F.sha2(text, 256)


def distinct_work(df: DataFrame, text: str, ordinal: str) -> DataFrame:
    """One row per distinct text: its first ordinal and how often it occurs."""
    return df.groupBy(content_key(F.col(text)).alias("content_key")).agg(
        F.min(ordinal).alias("first_ordinal"), F.count(F.lit(1)).alias("uses")
    )


def exact_reuse(queries: DataFrame, cache: DataFrame, text: str = "value") -> DataFrame:
    """Left join on the hash of the text: ``output`` and ``hit``. ``cache`` has content_key, output, created_at."""
    newest = cache.groupBy("content_key").agg(F.max_by("output", "created_at").alias("output"))
    return (
        queries.withColumn("content_key", content_key(F.col(text)))
        .join(newest, "content_key", "left")
        .withColumn("hit", F.col("output").isNotNull())
    )


# ----------------------------------------------------------- similarity cache


def live_entries(cache: DataFrame, ttl_seconds: int | None, now: Column | None = None) -> DataFrame:
    """Entries younger than the time to live; None or a negative value keeps all."""
    if ttl_seconds is None or ttl_seconds < 0:
        return cache
    at = now if now is not None else F.current_timestamp()
    return cache.filter(F.col("created_at") > at - F.make_dt_interval(secs=F.lit(ttl_seconds)))


def cache_store(entries: DataFrame, path: str) -> None:
    """Append (cache_id, embedding, output, created_at) entries."""
    entries.select("cache_id", "embedding", "output", "created_at").write.mode("append").parquet(path)


def compact_cache(cache: DataFrame, ttl_seconds: int | None, new_path: str, now: Column | None = None) -> None:
    """Write the live entries to a new folder; the reader is then pointed to it."""
    live_entries(cache, ttl_seconds, now).write.mode("error").parquet(new_path)


def _units(frames, id_col: str):
    """Unit vectors as bytes, with a content hash; vectors without direction are left out."""
    for frame in frames:
        if not len(frame):
            continue
        matrix = np.stack(frame["embedding"].to_numpy()).astype(np.float32)
        norms = np.linalg.norm(matrix, axis=1)
        usable = np.isfinite(norms) & (norms > 0)
        units = (matrix[usable] / norms[usable, None]).astype(np.float32)
        raw = [row.tobytes() for row in units]
        yield frame.loc[usable].drop(columns=["embedding"]).assign(
            vec_key=[hashlib.blake2b(b, digest_size=16).hexdigest() for b in raw], vec=raw
        )


def _matrix(column) -> np.ndarray:
    return np.stack([np.frombuffer(b, dtype=np.float32) for b in column])


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (vectors.astype(np.float64) @ pivots.T.astype(np.float64)), 0.0))


# Bytes that a task computes or passes on at a time, for its rows against all cells.
_SLICE_BYTES = 32 << 20


def _slices(frame: pd.DataFrame, row_bytes: int):
    """The frame in runs of rows of about ``_SLICE_BYTES``, each row counted with ``row_bytes``."""
    step = max(1, _SLICE_BYTES // max(1, row_bytes))
    for start in range(0, len(frame), step):
        yield frame.iloc[start : start + step]


def _nearest_cells(frame: pd.DataFrame, pivots: np.ndarray):
    """Every row with its nearest pivot (``cell``) and the distance to it (``gap``)."""
    for part in _slices(frame, 32 * len(pivots)):
        gaps = _distances(_matrix(part["vec"]), pivots)
        nearest = gaps.argmin(axis=1)
        yield part.assign(cell=nearest.astype(np.int32), gap=gaps[np.arange(len(part)), nearest])


def _visits(frame: pd.DataFrame, pivots: np.ndarray, radius: np.ndarray, reach: float):
    """A row per query and cell that can hold an entry within reach.

    With a low threshold these are nearly all cells, each with a copy of the vector: the rows are made in slices.
    """
    for part in _slices(frame, (96 + 4 * pivots.shape[1]) * len(pivots)):
        gaps = _distances(_matrix(part["vec"]), pivots)
        near = gaps.min(axis=1, keepdims=True)
        rows, found = np.nonzero((radius >= 0) & (gaps <= radius + reach) & (gaps - near <= 2 * reach))
        yield pd.DataFrame(
            {
                "query_key": part["vec_key"].to_numpy()[rows],
                "query_vec": part["vec"].to_numpy()[rows],
                "cell": found.astype(np.int32),
            }
        )


def _ceil_div(a: Column, b: int) -> Column:
    return F.greatest(F.ceil(a / b), F.lit(1)).cast("int")


def cache_lookup(
    queries: DataFrame,
    cache: DataFrame,
    threshold: float = 0.95,
    ttl_seconds: int | None = None,
    now: Column | None = None,
    query_id: str = "query_id",
    max_cells: int = 4096,
    cache_block: int = 8192,
    query_block: int = 32768,
) -> DataFrame:
    """The most similar live entry of every query, where its cosine reaches the threshold. Exact.

    Adds ``hit``, ``similarity``, ``cache_id``, ``output`` and ``age_seconds``;
    misses keep NULLs. Equal similarity: the newest entry, then the smallest id.

    Entries are assigned to the nearest of a few pivot vectors. A query visits
    only cells that can hold an entry within the threshold distance (triangle
    inequality), which loses nothing. Cell membership is an equi-join; a large
    cell is cut into blocks on both sides, so that one task never gets more than
    one block pair, whatever the skew. Equal vectors are compared once.
    """
    spark = queries.sparkSession
    id_type = queries.schema[query_id].dataType.simpleString()
    cache_type = cache.schema["cache_id"].dataType.simpleString()
    live = live_entries(cache, ttl_seconds, now)

    asked = queries.select(query_id, "embedding").mapInPandas(
        lambda frames: _units(frames, query_id), f"{query_id} {id_type}, vec_key string, vec binary"
    )
    stored = live.select("cache_id", "created_at", "embedding").mapInPandas(
        lambda frames: _units(frames, "cache_id"),
        f"cache_id {cache_type}, created_at {live.schema['created_at'].dataType.simpleString()}, vec_key string, vec binary",
    )
    # Per distinct vector the entry that wins a tie.
    entries = materialise(
        stored.groupBy("vec_key").agg(
            F.max("created_at").alias("created_at"), F.first("vec").alias("vec")
        )
    )
    winners = stored.select("vec_key", "created_at", "cache_id").groupBy("vec_key", "created_at").agg(
        F.min("cache_id").alias("cache_id")
    )
    n_entries = entries.count()
    reach = math.sqrt(max(0.0, 2.0 - 2.0 * threshold)) + 1e-5
    n_cells = 1 if reach >= 1.0 else max(1, min(max_cells, math.isqrt(n_entries)))
    # Hash-ordered, so a fixed pseudo-random sample of at most max_cells vectors.
    sample = entries.select("vec_key", "vec").orderBy("vec_key").limit(n_cells).collect()
    pivots = _matrix([bytes(r["vec"]) for r in sample]) if sample else np.zeros((0, 1), np.float32)

    def to_cells(frames):
        for frame in frames:
            yield from _nearest_cells(frame, pivots)

    placed = entries.mapInPandas(
        to_cells,
        f"vec_key string, created_at {entries.schema['created_at'].dataType.simpleString()}, "
        "vec binary, cell int, gap double",
    )
    # One row per cell: at most max_cells rows.
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("radius")).collect()
    radius = np.full(max(len(pivots), 1), -1.0)
    blocks = {r["cell"]: max(1, math.ceil(r["n"] / cache_block)) for r in cells}
    for r in cells:
        radius[r["cell"]] = r["radius"]

    def to_visits(frames):
        for frame in frames:
            if len(pivots):
                yield from _visits(frame, pivots, radius, reach)

    distinct_queries = materialise(asked.select("vec_key", "vec").dropDuplicates(["vec_key"]))
    visits = distinct_queries.mapInPandas(to_visits, "query_key string, query_vec binary, cell int")
    asked_per_cell = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    grid = pd.DataFrame(
        [(c, blocks[c], max(1, math.ceil(n / query_block))) for c, n in asked_per_cell.items()],
        columns=["cell", "entry_blocks", "query_blocks"],
    )
    grid_df = F.broadcast(spark.createDataFrame(grid, "cell int, entry_blocks int, query_blocks int"))

    left = (
        visits.join(grid_df, "cell")
        .withColumn("qb", F.pmod(F.xxhash64("query_key"), F.col("query_blocks")).cast("int"))
        .withColumn("eb", F.explode(F.sequence(F.lit(0), F.col("entry_blocks") - 1)))
        .select("cell", "qb", "eb", "query_key", "query_vec")
    )
    right = (
        placed.join(grid_df, "cell")
        .withColumn("eb", F.pmod(F.xxhash64("vec_key"), F.col("entry_blocks")).cast("int"))
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
        .select("cell", "qb", "eb", "vec_key", "vec", F.col("created_at").cast("timestamp").alias("at"))
    )

    def best_of_block(asked_rows: pd.DataFrame, entry_rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked_rows) and len(entry_rows):
            ordered = entry_rows.sort_values(["at", "vec_key"], ascending=[False, True], kind="stable")
            entry_matrix = _matrix(ordered["vec"]).astype(np.float64)
            names = ordered["vec_key"].to_numpy()
            for start in range(0, len(asked_rows), 1024):
                part = asked_rows.iloc[start : start + 1024]
                scores = np.round(_matrix(part["query_vec"]).astype(np.float64) @ entry_matrix.T, 9)
                top = scores.argmax(axis=1)
                value = scores[np.arange(len(part)), top]
                hit = value >= threshold
                out.append(
                    pd.DataFrame(
                        {
                            "query_key": part["query_key"].to_numpy()[hit],
                            "entry_key": names[top[hit]],
                            "similarity": value[hit],
                        }
                    )
                )
        return pd.concat(out) if out else pd.DataFrame({"query_key": [], "entry_key": [], "similarity": []})

    found = (
        left.groupBy("cell", "qb", "eb")
        .cogroup(right.groupBy("cell", "qb", "eb"))
        .applyInPandas(best_of_block, "query_key string, entry_key string, similarity double")
    )
    named = found.join(
        entries.select(F.col("vec_key").alias("entry_key"), F.col("created_at")), "entry_key"
    )
    best = named.groupBy("query_key").agg(
        F.max_by(
            F.struct("entry_key", "similarity", "created_at"), F.struct("similarity", "created_at", "entry_key")
        ).alias("b")
    ).select("query_key", "b.*")
    # An id may be stored again: the output is that of the entry that won, one of them if both moments agree.
    outputs = live.groupBy("cache_id", "created_at").agg(F.max("output").alias("output"))
    chosen = (
        best.join(winners.withColumnRenamed("vec_key", "entry_key"), ["entry_key", "created_at"])
        .join(outputs, ["cache_id", "created_at"])
        .select("query_key", "cache_id", "output", "similarity", "created_at")
    )
    at = now if now is not None else F.current_timestamp()
    hits = asked.select(query_id, F.col("vec_key").alias("query_key")).join(chosen, "query_key").drop("query_key")
    return (
        queries.join(hits, query_id, "left")
        .withColumn("hit", F.col("cache_id").isNotNull())
        .withColumn("age_seconds", F.unix_seconds(at.cast("timestamp")) - F.unix_seconds(F.col("created_at").cast("timestamp")))
        .drop("created_at")
    )


# --------------------------------------------------------- compiled transforms

SPEC_COLUMNS = "fingerprint string, type string, code string, created_at timestamp, model string"
DECLARATIVE, SQL_EXPR = "DECLARATIVE", "SQL_EXPR"
# Up to so many mapping specs become branches of the plan; beyond, they are applied as data. Only speed differs.
UNROLL_LIMIT = 64
# SQL expressions can only be branches of a plan, so many of them are run in groups, each a plan of its own.
SQL_GROUP = 128
# Up to so many failed structures (a hash each) are broadcast to their records; beyond, the join is left to Spark.
BROADCAST_VERDICTS = 100_000


def live_specs(
    log: DataFrame, ttl_seconds: int = -1, now: Column | None = None, invalidations: DataFrame | None = None
) -> DataFrame:
    """The current spec per fingerprint: the last one put, not expired, not invalidated since."""
    rest = [c for c in log.columns if c != "fingerprint"]
    current = (
        log.groupBy("fingerprint")
        .agg(F.max_by(F.struct(*rest), F.col("created_at")).alias("_s"))
        .select("fingerprint", "_s.*")
    )
    if invalidations is not None:
        dropped = invalidations.groupBy("fingerprint").agg(F.max("invalidated_at").alias("_dropped_at"))
        current = (
            current.join(dropped, "fingerprint", "left")
            .filter(F.col("_dropped_at").isNull() | (F.col("_dropped_at") < F.col("created_at")))
            .drop("_dropped_at")
        )
    if ttl_seconds is not None and ttl_seconds >= 0:
        at = now if now is not None else F.current_timestamp()
        current = current.filter(F.col("created_at") >= at - F.make_dt_interval(secs=F.lit(ttl_seconds)))
    return current


_SPEC = "mappings map<string,variant>, defaults map<string,variant>, typeCasts map<string,string>"


def _prepared(code: Column) -> Column:
    """A mapping spec as a struct whose paths are cut into steps; NULL if it is none."""
    spec = F.from_json(code, _SPEC)

    def entry(e: Column) -> Column:
        # A path that is not a text resolves to nothing.
        path = F.when(F.schema_of_variant(e["value"]) == "STRING", F.try_variant_get(e["value"], "$", "string"))
        return F.struct(e["key"].alias("name"), (path == "").alias("whole"), V.steps_of(path).alias("steps"))

    empty = F.from_json(F.lit("{}"), "map<string,variant>")
    return F.when(
        spec["mappings"].isNotNull(),
        F.struct(
            F.transform(F.map_entries(spec["mappings"]), entry).alias("paths"),
            F.map_keys(spec["mappings"]).alias("names"),
            F.coalesce(spec["defaults"], empty).alias("defaults"),
            spec["typeCasts"].alias("typeCasts"),
        ),
    )


def _mapped_by_data(variant: Column, spec: Column) -> Column:
    """A prepared spec held as a struct column, applied without unrolling it into the plan."""
    casts = spec["typeCasts"]

    def value_at(entry: Column) -> Column:
        return F.when(entry["whole"], variant).otherwise(V.follow(variant, entry["steps"]))

    def finish(name: Column, value: Column) -> Column:
        wanted = F.element_at(casts, name)
        out = value
        for target in ("integer", "number", "boolean", "string"):
            out = F.when(wanted == target, V.cast_json(value, target)).otherwise(out)
        return out

    named = F.concat(
        F.transform(
            spec["paths"],
            lambda e: F.struct(
                e["name"].alias("key"), F.coalesce(value_at(e), F.element_at(spec["defaults"], e["name"])).alias("value")
            ),
        ),
        F.transform(
            F.filter(F.map_entries(spec["defaults"]), lambda e: ~F.array_contains(spec["names"], e["key"])),
            lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")),
        ),
    )
    present = F.filter(named, lambda e: e["value"].isNotNull())
    return F.to_json(
        F.map_from_entries(
            F.transform(present, lambda e: F.struct(e["key"].alias("key"), finish(e["key"], e["value"]).alias("value")))
        )
    )


def _usable(row) -> bool:
    if row["type"] == DECLARATIVE:
        return is_mapping_spec(row["code"])
    try:
        return isinstance(json.loads(row["code"]), dict)
    except ValueError:
        return False


def _with_output(df: DataFrame, specs: DataFrame, value: str) -> DataFrame:
    """Adds ``output``: the record under the spec of its fingerprint, NULL without one."""
    if specs.isEmpty():
        return df.withColumn("output", F.lit(None).cast("string"))
    scripted = specs.filter(F.col("type") == SQL_EXPR).select("fingerprint", "type", "code")
    first = scripted.limit(SQL_GROUP + 1).collect()
    if len(first) > SQL_GROUP:
        return _with_output_in_groups(df, specs, scripted, value)
    return _by_mappings(_by_scripts(df, first, value), specs, value)


def _by_scripts(df: DataFrame, scripted: list, value: str) -> DataFrame:
    """Adds ``input``, and ``output`` by the SQL specs of one group, as branches of the plan."""
    df = compute_once(df, {"input": V.parse(F.col(value))})
    output = F.lit(None).cast("string")
    for row in scripted:
        if _usable(row):
            output = F.when(F.col("fingerprint") == row["fingerprint"], expressed(json.loads(row["code"]))).otherwise(output)
    return df.withColumn("output", output)


def _by_mappings(df: DataFrame, specs: DataFrame, value: str) -> DataFrame:
    """Fills ``output`` where a mapping spec applies, and drops ``input``."""
    declarative = specs.filter(F.col("type") == DECLARATIVE)
    few = declarative.limit(UNROLL_LIMIT + 1).collect()
    output = F.col("output")
    if len(few) <= UNROLL_LIMIT:
        for row in few:
            if _usable(row):
                output = F.when(
                    F.col("fingerprint") == row["fingerprint"], mapped(F.col("input"), json.loads(row["code"]))
                ).otherwise(output)
        return compute_once(df, {"output": F.when(F.col("input").isNotNull(), output)}).drop("input")
    # Each spec is read once, before it meets its records.
    codes = compute_once(declarative.select("fingerprint", "code"), {"_spec": _prepared(F.col("code"))}).drop("code")
    by_data = F.when(F.col("_spec").isNotNull(), _mapped_by_data(F.col("input"), F.col("_spec")))
    return compute_once(
        df.join(codes, "fingerprint", "left"),
        {"output": F.when(F.col("input").isNotNull(), F.coalesce(output, by_data))},
    ).drop("input", "_spec")


def _in_groups(specs: DataFrame) -> tuple[DataFrame, int]:
    """Specs numbered by groups of SQL_GROUP in the order of their fingerprints, and how many groups there are."""
    numbered = positions(specs, ["fingerprint"]).withColumn("_group", F.floor(F.col("_pos") / SQL_GROUP).cast("int"))
    numbered = materialise(numbered.drop("_pos"))
    return numbered, (numbered.agg(F.max("_group")).first()[0] or 0) + 1


def _with_output_in_groups(df: DataFrame, specs: DataFrame, scripted: DataFrame, value: str) -> DataFrame:
    """``_with_output`` for any number of SQL specs: one bounded plan after another, over the records of its group only.

    Records are shuffled once, by group and hash of the value, so that a structure with a third of them fills
    many tasks and a task writes few files. The driver holds the specs of one group at a time.
    """
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/recordflow-groups-{uuid.uuid4().hex}"
    codes, groups = _in_groups(scripted)
    placed = df.join(codes.select("fingerprint", "_group"), "fingerprint", "left").select(*df.columns, "_group")
    # Records of no SQL spec are group -1.
    placed = placed.withColumn("_group", F.coalesce("_group", F.lit(-1)))
    spread = placed.withColumn("_salt", F.xxhash64(value)).repartitionByRange(spread_count(df), "_group", "_salt")
    spread.drop("_salt").write.partitionBy("_group").parquet(f"{folder}/in")
    stored = spark.read.schema(placed.schema).parquet(f"{folder}/in")
    for group in range(groups):
        one = codes.filter(F.col("_group") == group).collect()
        ran = _by_scripts(stored.filter(F.col("_group") == group).drop("_group"), one, value)
        checked = ran.withColumn("output", F.when(F.col("input").isNotNull(), F.col("output"))).drop("input")
        checked.write.mode("append").parquet(f"{folder}/out")
    loose = _by_mappings(_by_scripts(stored.filter(F.col("_group") == -1).drop("_group"), [], value), specs, value)
    done = spark.read.schema(loose.schema).parquet(f"{folder}/out")
    return loose.unionByName(done)


def apply_compiled(
    df: DataFrame, specs: DataFrame, contract: Contract, value: str = "value"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Run each record through the spec of its structure: (done, rest, invalid specs).

    ``df`` carries ``fingerprint``. If any record of a structure violates the
    contract, that spec is invalid and all records of the structure go to ``rest``.
    A NULL value passes through as done. Only fingerprints (one row per
    structure) are shuffled for the verdict, not the records: a shuffle by
    fingerprint would leave all records of a structure to one task.
    """
    ran = _with_output(df, specs, value)
    parsed = compute_once(ran, {"_out": V.parse(F.col("output"))})
    errors = error_list(F.col("_out"), F.col("output"), contract)
    checked = compute_once(parsed, {"_ok": F.when(F.col("output").isNotNull(), F.size(errors) == 0)})
    verdict = (
        checked.filter(F.col("output").isNotNull())
        .groupBy("fingerprint")
        .agg(F.bool_and("_ok").alias("valid"), F.count_if(~F.col("_ok")).alias("failed"))
    )
    invalid = materialise(verdict.filter(~F.col("valid")).select("fingerprint", "failed"))
    marks = invalid.select("fingerprint", F.lit(True).alias("_bad"))
    # What is materialised has no size that Spark knows of.
    few = invalid.limit(BROADCAST_VERDICTS + 1).count() <= BROADCAST_VERDICTS
    judged = ran.join(F.broadcast(marks) if few else marks, "fingerprint", "left")
    is_done = F.col(value).isNull() | (F.col("output").isNotNull() & F.col("_bad").isNull())
    done = judged.filter(is_done).withColumn(value, F.col("output")).drop("output", "_bad")
    rest = judged.filter(~is_done).drop("output", "_bad")
    return done, rest, invalid


def samples_per_structure(df: DataFrame, order: str, size: int = 3) -> DataFrame:
    """The first records of each structure. The rank limit applies before the shuffle, so no group is collected."""
    rank = F.row_number().over(Window.partitionBy("fingerprint").orderBy(order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= size).drop("_rank")


NEEDS_SQL = "NEEDS_SQL"


def compile_specs(
    df: DataFrame,
    client,
    contract: Contract,
    order: str,
    known: DataFrame | None = None,
    model: str | None = None,
    value: str = "value",
    tries: int = 3,
    shown=None,
    **call_options,
) -> DataFrame:
    """Propose a spec for every structure not yet known and keep those that pass on its samples.

    First a declarative mapping is asked for; structures it does not fit get up
    to ``tries`` attempts at SQL expressions. Returns spec rows (one per solved
    structure). The number of calls is one per structure and attempt. ``shown``
    (DataFrame to DataFrame) is applied to the one sample of each structure
    that a model gets to see: mask it there.
    """
    fresh = df.filter(F.col(value).isNotNull() & V.parse(F.col(value)).isNotNull())
    if known is not None:
        fresh = fresh.join(known.select("fingerprint"), "fingerprint", "left_anti")
    samples = materialise(samples_per_structure(fresh.select("fingerprint", value, order), order))
    first = samples.groupBy("fingerprint").agg(F.min_by(value, order).alias("_sample"))
    if shown is not None:
        first = shown(first.withColumnRenamed("_sample", "value")).withColumnRenamed("value", "_sample")
    described = materialise(first.withColumn("_shape", V.describe(F.col("_sample"))))

    solved: list[DataFrame] = []
    open_ = described.withColumn("_previous", F.lit(None).cast("string"))
    for attempt in range(tries + 1):
        kind = DECLARATIVE if attempt == 0 else SQL_EXPR
        wanted = (
            'a JSON object {"mappings": {"out": "$.path"}, "defaults": {}, "typeCasts": {"out": '
            '"integer|number|boolean|string"}}, or the word ' + NEEDS_SQL + " if paths and casts are not enough"
            if kind == DECLARATIVE
            else "a JSON object of output name to Spark SQL expression over the VARIANT column input"
        )
        asked = open_.withColumns(
            {
                "system_prompt": F.lit("You write data transformations. Answer with the specification only."),
                "user_prompt": F.concat(
                    F.lit(f"Write {wanted}.\nTarget JSON Schema: {contract.text}\nStructure: "),
                    F.col("_shape"),
                    F.lit("\nSample: "),
                    F.col("_sample"),
                    F.coalesce(F.concat(F.lit("\nThis earlier answer failed: "), F.col("_previous")), F.lit("")),
                ),
                "model": F.lit(model).cast("string"),
            }
        )
        answered = complete(asked, client, want_array=False, **call_options)
        proposed = materialise(
            answered.select(
                "fingerprint",
                F.lit(kind).alias("type"),
                V.code_block(F.col("content")).alias("code"),
                F.current_timestamp().alias("created_at"),
                F.col("answer_model").alias("model"),
            )
        )
        accepted = _accepted(proposed, samples, contract, value)
        solved.append(proposed.join(accepted, "fingerprint", "left_semi"))
        failed = proposed.join(accepted, "fingerprint", "left_anti").select(
            "fingerprint", F.when(F.col("type") == SQL_EXPR, F.col("code")).alias("_previous")
        )
        open_ = materialise(described.join(failed, "fingerprint"))
        if open_.isEmpty():
            break
    out = solved[0]
    for part in solved[1:]:
        out = out.unionByName(part)
    return out


def _accepted(proposed: DataFrame, samples: DataFrame, contract: Contract, value: str) -> DataFrame:
    """Fingerprints whose proposal parses and gives conforming output on all samples."""

    def readable(frames):
        for frame in frames:
            sound = [bool(code) and _usable({"type": kind, "code": code}) for kind, code in zip(frame["type"], frame["code"])]
            yield frame[sound]

    sound = materialise(proposed.select("fingerprint", "type", "code").mapInPandas(readable, "fingerprint string, type string, code string"))
    scripted = sound.filter(F.col("type") == SQL_EXPR)
    usable = sound.filter(F.col("type") == DECLARATIVE)
    if not scripted.isEmpty():
        usable = usable.unionByName(_analysed(scripted))
    ran = _with_output(samples.join(usable.select("fingerprint"), "fingerprint", "left_semi"), usable, value)
    errors = F.size(error_list(V.parse(F.col("output")), F.col("output"), contract)) == 0
    return (
        ran.groupBy("fingerprint")
        .agg(F.bool_and(F.coalesce(errors, F.lit(False)) & F.col("output").isNotNull()).alias("_ok"))
        .filter("_ok")
        .select("fingerprint")
    )


def _analysed(scripted: DataFrame) -> DataFrame:
    """The SQL specs that Spark can analyse. Only the driver can, so it reads them a group at a time and writes what it passes."""
    spark = scripted.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/recordflow-analysed-{uuid.uuid4().hex}"
    codes, groups = _in_groups(scripted)
    probe = spark.createDataFrame([], "v string").select(V.parse(F.col("v")).alias("input"))
    for group in range(groups):
        good = []
        for row in codes.filter(F.col("_group") == group).collect():
            try:
                probe.select(expressed(json.loads(row["code"]))).schema  # noqa: B018 - analysis only
            except Exception:
                continue
            good.append((row["fingerprint"], row["type"], row["code"]))
        spark.createDataFrame(good, "fingerprint string, type string, code string").write.mode("append").parquet(folder)
    return spark.read.schema("fingerprint string, type string, code string").parquet(folder)
