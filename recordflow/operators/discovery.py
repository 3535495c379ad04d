"""Structures found in nested records: every path, the types seen there, and a JSON Schema of all.

A record is opened level by level: what stands in an object or an array becomes rows of the next
level, under the path of its place (``.name`` of an object, ``[]`` for all elements of
an array, ``.*`` for objects whose keys are data). All rows of a level become counts per path,
and counts merge: so do the results of two parts of the data (``merge_paths``).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V
from .staging import compute_once, materialise

# Kinds from the least general to the most; an integer is a number too.
SCALARS = ("boolean", "integer", "number", "string")
# An object with at least this many names, of which its instances hold this share at most, has data as keys.
DATA_KEYS = 50
DATA_SHARE = 0.2
_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _name(key: Column) -> Column:
    """One step of a path; names with other characters are quoted as JSON."""
    return F.when(key.rlike(r"\A[A-Za-z_][A-Za-z0-9_]*\z"), F.concat(F.lit("."), key)).otherwise(F.to_json(F.array(key)))


def _data_parents(level: DataFrame, above: DataFrame, data_keys: int, share: float) -> DataFrame:
    """Paths of objects whose keys are data: many names, each in few of the objects (``above``: counts of the level above)."""
    names = level.filter("key is not null").groupBy("parent", "key").agg(F.count(F.lit(1)).alias("n"))
    whole = names.groupBy("parent").agg(F.count(F.lit(1)).alias("names"), F.max("n").alias("most"))
    objects = above.filter("kind = 'object'").select(F.col("path").alias("parent"), F.col("occurrences").alias("objects"))
    return (
        whole.join(objects, "parent")
        .filter((F.col("names") >= data_keys) & (F.col("most") <= F.greatest(F.lit(1), share * F.col("objects"))))
        .select("parent", F.lit(True).alias("is_data"))
    )


_PLACE = ["path", "parent", "kind"]
_COUNTS = "path string, parent string, kind string, occurrences bigint, first_value string, last_value string"
# So many paths are held by a task before they are passed on.
_HELD = 20_000


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (path, parent, kind, text) rows, merged batch by batch: a task holds one row per path, and sorts nothing."""

    def merged(rows: pa.Table) -> pa.Table:
        made = rows.group_by(_PLACE, use_threads=False).aggregate([("occurrences", "sum"), ("first_value", "min"), ("last_value", "max")])
        return made.select([*_PLACE, "occurrences_sum", "first_value_min", "last_value_max"]).rename_columns(names)

    names = [*_PLACE, "occurrences", "first_value", "last_value"]
    held = None
    for batch in batches:
        one, text = pa.array([1] * batch.num_rows, pa.int64()), batch.column("text")
        part = merged(pa.table([*[batch.column(c) for c in _PLACE], one, text, text], names=names))
        held = part if held is None else merged(pa.concat_tables([held, part]))
        if held.num_rows >= _HELD:
            yield from held.to_batches()
            held = None
    if held is not None:
        yield from held.to_batches()


def discover_paths(
    df: DataFrame,
    value: str = "value",
    data_keys: int = DATA_KEYS,
    data_share: float = DATA_SHARE,
    most_levels: int = 64,
) -> DataFrame:
    """One row per path and kind: path, parent (path of what holds it), kind, occurrences, first_value and last_value.

    ``$`` is the record itself. Kinds: object, array, string, integer, number, boolean, null. Values are the least and
    the greatest as text, of scalars. A record that is not JSON, or null, is left out; equal keys make a
    record unparseable. Records nested deeper than ``most_levels`` raise, rather than being cut.

    Scale: one pass over the values of each level, counted in Arrow batches before the shuffle, so that texts are
    neither sorted nor held and no row of a level moves; what is opened next is stored in the shared folder. Keys that are data are merged into one path, so
    that the result is bounded by the shape of the records, not by their number.
    """
    rows = df.select(F.try_parse_json(F.col(value).cast("string")).alias("v")).filter("v is not null")
    spark = df.sparkSession
    level = rows.select(F.lit("").alias("parent"), F.lit(None).cast("string").alias("key"), "v")
    found, counts, depth = None, None, 0
    while True:
        depth += 1
        level = materialise(compute_once(level, {"kind": V.kind(F.col("v"))}))
        if depth > 1:
            # A row per object path whose keys are data: their children share one path. Few, so the level stays where it is.
            data = materialise(_data_parents(level, counts, data_keys, data_share))
            marked = level.join(F.broadcast(data), "parent", "left")
            step = F.when(F.col("key").isNull(), "[]").when(F.col("is_data"), ".*").otherwise(_name(F.col("key")))
        else:
            marked, step = level, F.lit("$")
        text = F.when(F.col("kind").isin(*SCALARS), V.text_of(F.col("v")))
        marked = marked.withColumn("path", F.concat("parent", step))
        counts = materialise(merge_paths(marked.select(*_PLACE, text.alias("text")).mapInArrow(_counted, _COUNTS)))
        found = counts if found is None else found.unionByName(counts)
        holds_more = F.col("kind").isin("object", "array")
        if counts.filter(holds_more).isEmpty():
            break
        if depth == most_levels:
            raise ValueError(f"records are nested deeper than {most_levels} levels")
        level = marked.filter(holds_more).select("path", "v").lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).toDF("_at", "_key", "_inner")).select(
            F.col("path").alias("parent"), F.col("_key").alias("key"), F.col("_inner").alias("v")
        )
    return found


def merge_paths(*parts: DataFrame) -> DataFrame:
    """The counts of several parts of the data, as those of all of it. (Whether keys are data is found per part.)"""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(*_PLACE).agg(
        F.sum("occurrences").alias("occurrences"), F.min("first_value").alias("first_value"), F.max("last_value").alias("last_value")
    )


def path_types(counts: DataFrame) -> DataFrame:
    """One row per path: kinds (without null, integer within number), occurrences, required, nullable.

    A member is required if every object at its parent has it; elements of arrays and
    keys that are data are never required.
    """
    kinds = F.array_sort(F.collect_set(F.when(F.col("kind") != "null", F.col("kind"))))
    held = counts.groupBy("path", "parent").agg(
        kinds.alias("kinds"), F.sum("occurrences").alias("occurrences"), F.max(F.when(F.col("kind") == "null", 1).otherwise(0)).alias("_null")
    )
    joined = F.when(F.array_contains("kinds", "number"), F.array_remove("kinds", "integer")).otherwise(F.col("kinds"))
    objects = counts.filter("kind = 'object'").select(F.col("path").alias("_path"), F.col("occurrences").alias("_objects"))
    loose = F.col("path").endswith("[]") | F.col("path").endswith(".*")
    return held.join(objects, held["parent"] == objects["_path"], "left").select(
        "path", "parent", joined.alias("kinds"), "occurrences",
        ((F.col("parent") == "") | F.coalesce(~loose & (F.col("occurrences") == F.col("_objects")), F.lit(False))).alias("required"),
        (F.col("_null") == 1).alias("nullable"),
    )


def nested_schema(counts: DataFrame) -> dict:
    """A JSON Schema of the records. What reaches the driver is one row per path."""
    rows = {r.path: r for r in path_types(counts).collect()}
    inner: dict[str, list[str]] = {}
    for path, r in rows.items():
        inner.setdefault(r.parent, []).append(path)

    def spec(path: str) -> dict:
        r = rows[path]
        kinds = [*r.kinds, *(["null"] if r.nullable or not r.kinds else [])]
        out: dict = {"type": kinds[0] if len(kinds) == 1 else kinds}
        children = sorted(inner.get(path, []))
        named = [c for c in children if not c.endswith("[]") and c != f"{path}.*"]
        if "object" in r.kinds:
            out["properties"] = {_key(c[len(path) :]): spec(c) for c in named}
            out["required"] = [_key(c[len(path) :]) for c in named if rows[c].required]
            if f"{path}.*" in rows:
                out["additionalProperties"] = spec(f"{path}.*")
        if "array" in r.kinds and f"{path}[]" in rows:
            out["items"] = spec(f"{path}[]")
        return out

    return spec("$") if "$" in rows else {"type": "object", "properties": {}, "required": []}


def _key(step: str) -> str:
    return step[1:] if _PLAIN.fullmatch(step[1:]) else json.loads(step)[0]


def contract_of(schema: dict) -> dict:
    """The part of a schema that a contract checks: the fields of the record, with one type each, and which are required.

    Fields of several types, and nullable ones, are named without a type.
    """
    fields = schema.get("properties", {})
    types = {k: {"type": f["type"]} if isinstance(f["type"], str) and f["type"] != "null" else {} for k, f in fields.items()}
    return {"type": "object", "properties": types, "required": list(schema.get("required", []))}
