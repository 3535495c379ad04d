"""Rule-based reshaping without a model: rename, infer types, normalise timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import variant as V
from .staging import compute_once

PATTERNS = ("field_rename", "type_cast", "timestamp_format")


def _entry(key: Column, value: Column, changed: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"), changed.alias("changed"))


def _rename(df: DataFrame, before: str, after: str) -> DataFrame:
    """Rename top-level keys; a renamed key replaces an existing one, the last renamed wins."""
    moved = F.transform(
        F.transform(F.col(before), lambda e: F.struct(T.camel_to_snake(e["key"]).alias("key"), e["key"].alias("old"), e["value"].alias("value"))),
        lambda e: _entry(e["key"], e["value"], e["key"] != e["old"]),
    )
    df = compute_once(df, {"_moved": moved})
    entries = F.col("_moved")
    ordered = F.concat(F.filter(entries, lambda e: ~e["changed"]), F.filter(entries, lambda e: e["changed"]))
    keys = F.transform(entries, lambda e: e["key"])
    collides = F.size(F.array_distinct(keys)) < F.size(keys)
    df = compute_once(df, {"_moved": F.when(collides, ordered).otherwise(entries), "_collides": collides})
    # Where keys collide, an entry survives if none with its key comes after it.
    last = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]),
    )
    return compute_once(df, {after: F.when(F.col("_collides"), last).otherwise(entries)}).drop("_moved", "_collides")


def _typed(value: Column) -> Column:
    """A text value as double, long or boolean; NULL when it stays as it is."""
    text = F.try_variant_get(value, "$", "string")
    inferred = F.when(
        text.contains("."), F.when(text.rlike(V.DOUBLE_TEXT), V.to_variant(text.try_cast("double")))
    ).otherwise(
        F.coalesce(
            F.when(text.rlike(V.LONG_TEXT), V.to_variant(text.try_cast("bigint"))),
            F.when(F.lower(text).isin("true", "false"), V.to_variant(F.lower(text) == "true")),
        )
    )
    return F.when(V.is_text(value), inferred)


def _timed(value: Column) -> Column:
    """A text value as canonical ISO instant; NULL when it stays as it is."""
    text = F.try_variant_get(value, "$", "string")
    iso = T.iso_instant(text)
    normal = F.when(iso.isNotNull(), F.when(iso != text, iso)).otherwise(T.epoch_instant(text))
    return F.when(V.is_text(value), V.to_variant(normal))


def _rewritten(entries: Column, rewrite) -> Column:
    return F.transform(
        F.transform(entries, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("old"), rewrite(e["value"]).alias("new"))),
        lambda e: _entry(e["key"], F.coalesce(e["new"], e["old"]), e["new"].isNotNull()),
    )


def apply_patterns(
    df: DataFrame,
    patterns: tuple[str, ...] | list[str] = PATTERNS,
    value: str = "value",
    batch_semantics: bool = False,
    batch: str = "batch_id",
) -> DataFrame:
    """Apply the rules in the listed order; adds ``handled``.

    A NULL value passes through as handled. A record that is not an object, or
    that no rule changed, is not handled and keeps its value. With
    ``batch_semantics`` one unhandled record marks its whole batch unhandled.
    """
    # The entry arrays are staged in columns so that each is computed once.
    df = compute_once(
        df,
        {
            "_e0": F.transform(
                F.map_entries(F.from_json(F.col(value), "map<string,variant>")),
                lambda e: _entry(e["key"], e["value"], F.lit(False)),
            )
        },
    )
    stages = ["_e0"]
    for name in patterns:
        if name not in PATTERNS:
            continue
        before, after = stages[-1], f"_e{len(stages)}"
        if name == "field_rename":
            df = _rename(df, before, after)
        else:
            df = compute_once(df, {after: _rewritten(F.col(before), _typed if name == "type_cast" else _timed)})
        stages.append(after)
    changed = F.lit(False)
    for stage in stages[1:]:
        changed = changed | F.exists(F.col(stage), lambda e: e["changed"])
    result = F.to_json(
        F.map_from_entries(F.transform(F.col(stages[-1]), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))))
    )
    handled = F.when(F.col(value).isNull(), F.lit(bool(patterns))).otherwise(F.coalesce(changed, F.lit(False)))
    df = compute_once(df, {"handled": handled})
    if batch_semantics:
        whole = df.groupBy(batch).agg(F.bool_and("handled").alias("_whole"))
        df = df.join(whole, batch).withColumn("handled", F.col("_whole")).drop("_whole")
    return compute_once(
        df, {value: F.when(F.col("handled") & F.col(value).isNotNull(), result).otherwise(F.col(value))}
    ).drop(*stages)
