"""Keyed inserts, updates and upserts into a target table, as joins.

Changes are first reduced to the last one per key (by an explicit ordinal, with
partial aggregation before the shuffle), so a key holding a third of all changes
costs one row per task. The large target is then joined only against that
reduced side, which Spark broadcasts when its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V
from .staging import compute_once


def latest_per_key(changes: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The last change per key; its ordinal must be unique within the key."""
    rest = [c for c in changes.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.col(ordinal)).alias("_last")
    return changes.groupBy(*keys).agg(last).select(*keys, *[F.col("_last")[c].alias(c) for c in rest])


def align_columns(df: DataFrame, target: DataFrame) -> DataFrame:
    """The target's columns and types: what is missing is NULL, what is extra is left out."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def records_to_rows(df: DataFrame, columns: dict[str, str], value: str = "value") -> DataFrame:
    """JSON records as typed columns; a nested value keeps its JSON text, a wrong type becomes NULL."""
    df = compute_once(df, {"_parsed": V.parse(F.col(value))})
    out = {}
    for name, type_name in columns.items():
        found = V.field(F.col("_parsed"), name)
        if type_name == "string":
            out[name] = F.when(~F.is_variant_null(found), F.try_variant_get(found, "$", "string"))
        else:
            out[name] = F.try_variant_get(found, "$", type_name)
    return df.withColumns(out).drop("_parsed")


def merge_insert(target: DataFrame, rows: DataFrame) -> DataFrame:
    return target.unionByName(align_columns(rows, target))


def merge_upsert(target: DataFrame, changes: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Insert new keys, overwrite the given non-key columns of known ones; the last change per key wins."""
    last = latest_per_key(changes, keys, ordinal).drop(ordinal)
    given = [c for c in target.columns if c not in keys and c in last.columns]
    if not given:
        fresh = last.join(target, keys, "left_anti")
        return target.unionByName(align_columns(fresh, target))
    if len(given) + len(keys) == len(target.columns):
        kept = target.join(last.select(*keys), keys, "left_anti")
        return kept.select(*target.columns).unionByName(align_columns(last, target))
    return _overwrite(target, last, keys, {c: None for c in given}, insert=True)


def merge_update(target: DataFrame, changes: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Overwrite the given non-key columns of existing keys; unknown keys are ignored."""
    last = latest_per_key(changes, keys, ordinal).drop(ordinal)
    given = [c for c in target.columns if c not in keys and c in last.columns]
    return _overwrite(target, last, keys, {c: None for c in given}, insert=False)


def merge_columns(
    target: DataFrame, changes: DataFrame, keys: list[str], ordinal: str, value: str = "value"
) -> DataFrame:
    """Per-column upsert of JSON records: absent fields keep the old value, an explicit null overwrites it.

    Changes to one key are folded column by column: the last record naming a
    column decides it.
    """
    columns = [f for f in target.schema.fields if f.name not in keys]
    parsed = compute_once(changes, {"_parsed": V.parse(F.col(value))})
    folded = parsed.groupBy(*keys).agg(
        *[
            # NULL pairs (field absent) are ignored by max_by, so the last record naming the field wins.
            F.max_by(
                F.struct(
                    F.when(
                        ~F.is_variant_null(V.field(F.col("_parsed"), f.name)),
                        F.try_variant_get(V.field(F.col("_parsed"), f.name), "$", f.dataType.simpleString()),
                    ).alias("v")
                ),
                F.when(V.field(F.col("_parsed"), f.name).isNotNull(), F.col(ordinal)),
            ).alias(f"_set_{f.name}")
            for f in columns
        ]
    )
    given = folded.select(
        *keys,
        *[
            F.when(F.col(f"_set_{f.name}").isNotNull(), F.col(f"_set_{f.name}")["v"]).alias(f.name)
            for f in columns
        ],
        *[F.col(f"_set_{f.name}").isNotNull().alias(f"_has_{f.name}") for f in columns],
    )
    return _overwrite(
        target, given, keys, {f.name: F.col(f"c._has_{f.name}") for f in columns}, insert=True
    )


def _overwrite(
    target: DataFrame, changes: DataFrame, keys: list[str], given: dict[str, Column | None], insert: bool
) -> DataFrame:
    """Target rows with given columns replaced where a change exists (and its presence flag holds).

    One join: with ``insert`` a full outer one, so that the target is read once and new keys fall out of the same
    match. Null keys match nothing: such target rows stay, such changes are new.
    """
    held = target.withColumn("_held", F.lit(True)).alias("t")
    same = [F.col(f"t.{k}") == F.col(f"c.{k}") for k in keys]
    joined = held.join(changes.withColumn("_hit", F.lit(True)).alias("c"), same, "full_outer" if insert else "left")
    fresh = F.col("t._held").isNull()
    columns = []
    for f in target.schema.fields:
        own, new = F.col(f"t.{f.name}"), F.col(f"c.{f.name}").cast(f.dataType) if f.name in changes.columns else None
        if f.name in given:
            flag = F.coalesce(F.col("c._hit"), F.lit(False))
            if given[f.name] is not None:
                flag = flag & F.coalesce(given[f.name], F.lit(False))
            own = F.when(fresh | flag, new).otherwise(own)
        elif insert and new is not None:
            own = F.when(fresh, new).otherwise(own)
        columns.append(own.alias(f.name))
    return joined.select(*columns)


def merge_replace(target: DataFrame, documents: DataFrame, id_col: str, ordinal: str) -> DataFrame:
    """Documents with an id replace the stored one whole; documents without an id are appended."""
    keyed = latest_per_key(documents.filter(F.col(id_col).isNotNull()), [id_col], ordinal)
    loose = documents.filter(F.col(id_col).isNull())
    kept = target.join(keyed.select(id_col), id_col, "left_anti").select(*target.columns)
    return kept.unionByName(align_columns(keyed, target)).unionByName(align_columns(loose, target))


def latest_values(
    records: DataFrame, ordinal: str, key: str = "key", value: str = "value", constant_key: str = "record"
) -> DataFrame:
    """Key to latest value; records without a key share one constant key."""
    return records.groupBy(F.coalesce(F.col(key), F.lit(constant_key)).alias("key")).agg(
        F.max_by(F.col(value), F.col(ordinal)).alias("value")
    )


def modify_or_add(target: DataFrame, records: DataFrame, ordinal: str, key: str = "dn", value: str = "value") -> DataFrame:
    """Replace the attributes a record names, or add the entry; records without a key field are skipped."""
    name = V.text_of(V.field(V.parse(F.col(value)), key))
    keyed = records.withColumn(key, name).filter(F.col(key).isNotNull() & (F.col(key) != ""))
    return merge_columns(target, keyed, [key], ordinal, value)
