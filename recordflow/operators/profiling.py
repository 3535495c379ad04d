"""Profiles of records and batches, the four-tier route, and the structures found in a table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import variant as V
from .staging import compute_once

# Fixed values of the routing rule.
SIMPLE_FIELDS = 5
COMPLEX_FIELDS = 20
COMPLEX_DEPTH = 3
TIER_REASONS = {
    0: "deterministic rules apply",
    1: "simple flat records",
    2: "moderate complexity",
    3: "complex or unparseable records",
}


def record_profile(df: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``fields``, ``depth``, ``bytes`` and ``parseable`` per record (all NULL for a NULL value)."""
    text = F.col(value)
    df = compute_once(
        df,
        {
            "parseable": F.when(text.isNotNull(), V.is_parseable(text)),
            "_bare": V.without_literals(text),
        },
    )
    df = compute_once(df, {"_brackets": V.brackets_of(F.col("_bare"))})
    return compute_once(
        df,
        {
            "fields": F.when(F.col("parseable"), V.count_of(F.col("_bare"), ":")),
            "depth": F.when(F.col("parseable"), V.bracket_depth(F.col("_brackets"))),
            "bytes": F.when(F.col("parseable"), F.octet_length(text)),
        },
    ).drop("_bare", "_brackets")


def batch_profile(df: DataFrame, value: str = "value", batch: str = "batch_id") -> DataFrame:
    """One row per batch: mean fields over all its records (integer), deepest record, bytes, all parseable."""
    return (
        record_profile(df, value)
        .groupBy(batch)
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.coalesce(F.sum("fields"), F.lit(0)).alias("total_fields"),
            F.coalesce(F.max("depth"), F.lit(0)).alias("max_depth"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
            F.coalesce(F.bool_and("parseable"), F.lit(True)).alias("all_parseable"),
        )
        .withColumn("avg_fields", F.floor(F.col("total_fields") / F.col("records")))
    )


def with_tier(df: DataFrame, models: dict[int, str] | None = None, patterns: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``tier``, ``model`` and ``reason`` to rows holding avg_fields, max_depth and all_parseable."""
    simple = F.col("all_parseable") & (F.col("avg_fields") <= SIMPLE_FIELDS) & (F.col("max_depth") <= 1)
    complex_ = (
        ~F.col("all_parseable") | (F.col("max_depth") > COMPLEX_DEPTH) | (F.col("avg_fields") > COMPLEX_FIELDS)
    )
    tier = F.when(simple, 0 if patterns else 1).when(complex_, 3).otherwise(2)
    names = F.lit(None).cast("string")
    for number, model in (models or {}).items():
        if number:
            names = F.when(F.col("tier") == number, F.lit(model)).otherwise(names)
    reasons = F.element_at(F.create_map(*[F.lit(x) for kv in TIER_REASONS.items() for x in kv]), F.col("tier"))
    return df.withColumn("tier", tier).withColumn("model", names).withColumn("reason", reasons)


def route(
    df: DataFrame,
    models: dict[int, str] | None = None,
    patterns: tuple[str, ...] = (),
    granularity: str = "batch",
    value: str = "value",
    batch: str = "batch_id",
) -> DataFrame:
    """Adds the cheapest capable tier to every record, decided per batch or per record."""
    if granularity == "batch":
        decided = with_tier(batch_profile(df, value, batch), models, patterns)
        return df.join(decided.select(batch, "tier", "model", "reason"), batch)
    single = record_profile(df, value).withColumns(
        {
            "all_parseable": F.coalesce(F.col("parseable"), F.lit(True)),
            "avg_fields": F.coalesce(F.col("fields"), F.lit(0)),
            "max_depth": F.coalesce(F.col("depth"), F.lit(0)),
        }
    )
    return with_tier(single, models, patterns).select(*df.columns, "tier", "model", "reason")


def with_fingerprint(
    df: DataFrame, target_schema: str = "", mode: str = "deep", value: str = "value", out: str = "fingerprint"
) -> DataFrame:
    return compute_once(df, {out: V.fingerprint(F.col(value), target_schema, mode)})


def schema_inventory(
    df: DataFrame, seen_at: str, target_schema: str = "", mode: str = "deep", value: str = "value"
) -> DataFrame:
    """Which structures occur, how often, and when first and last: the drift report."""
    return (
        with_fingerprint(df, target_schema, mode, value)
        .groupBy("fingerprint")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min(seen_at).alias("first_seen"),
            F.max(seen_at).alias("last_seen"),
        )
    )


def discover_fields(df: DataFrame, value: str = "value", enum_max: int = 10, sample: int | None = None) -> DataFrame:
    """One row per top-level field: kinds seen, whether in every record, and small value sets.

    Distinct values are kept per field only up to ``enum_max + 1`` (a rank limit
    applied before the shuffle), which decides exactly whether the set is small.
    """
    rows = df.select(F.col(value).alias("_value"))
    if sample:
        rows = rows.limit(sample)
    entries = rows.select(F.from_json("_value", "map<string,variant>").alias("_map")).filter("_map is not null")
    total = entries.agg(F.count(F.lit(1)).alias("records")).withColumn("_one", F.lit(1))
    exploded = entries.select(F.explode("_map").alias("field", "_v")).select(
        "field", V.kind(F.col("_v")).alias("kind"), V.text_of(F.col("_v")).alias("text")
    )
    kinds = (
        exploded.groupBy("field")
        .agg(
            F.count(F.lit(1)).alias("present"),
            F.array_sort(F.collect_set(F.when(F.col("kind") != "null", F.col("kind")))).alias("kinds"),
            F.max(F.when(F.col("kind") == "null", 1).otherwise(0)).alias("has_null"),
        )
    )
    ranked = (
        exploded.filter(F.col("kind").isin("string", "boolean", "integer"))
        .groupBy("field", "text")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_rank", F.row_number().over(Window.partitionBy("field").orderBy("text")))
        .filter(F.col("_rank") <= enum_max + 1)
    )
    values = ranked.groupBy("field").agg(F.array_sort(F.collect_list("text")).alias("_values"))
    return (
        kinds.join(values, "field", "left")
        .withColumn("_one", F.lit(1))
        .join(F.broadcast(total), "_one")  # one row
        .select(
            "field",
            "kinds",
            "present",
            (F.col("present") == F.col("records")).alias("required"),
            (F.col("has_null") == 1).alias("nullable"),
            F.when(
                (F.size("_values") <= enum_max) & (F.col("present") > F.size("_values")), F.col("_values")
            ).alias("values"),
        )
    )


def discover_schema(df: DataFrame, value: str = "value", enum_max: int = 10, sample: int | None = None) -> dict:
    """A JSON Schema from the data. Only the field table (one row per field) reaches the driver."""
    properties, required = {}, []
    for row in discover_fields(df, value, enum_max, sample).orderBy("field").collect():
        kinds = list(row["kinds"])
        if kinds == ["integer", "number"]:
            kinds = ["number"]
        spec: dict = {"type": kinds[0] if len(kinds) == 1 else "string"}
        if row["values"] and spec["type"] == "string" and kinds == ["string"]:
            spec["enum"] = list(row["values"])
        properties[row["field"]] = spec
        if row["required"]:
            required.append(row["field"])
    return {"type": "object", "properties": properties, "required": required}


def is_discovered_schema(text: str) -> bool:
    try:
        found = json.loads(text)
    except ValueError:
        return False
    return isinstance(found, dict) and "type" in found and "properties" in found
