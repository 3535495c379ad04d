"""Change events: decoding, applying them to a table, and the sequences that keep late and repeated ones out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import align_columns
from .staging import compute_once, materialise

# One attribute of an item in typed form: text, number as text, boolean, null, or anything else.
_ATTRIBUTE = "struct<S:string,N:string,BOOL:boolean,NUL:boolean,OTHER:string>"
_IMAGE = f"map<string,{_ATTRIBUTE}>"
EVENT_SCHEMA = f"eventName string, newImage {_IMAGE}, oldImage {_IMAGE}, keys {_IMAGE}"

# Event names of the change feed and the operations they stand for.
OPERATIONS = {"INSERT": "insert", "MODIFY": "update", "REMOVE": "delete"}


def _plain(image: Column) -> Column:
    """Typed attributes as a JSON object: text and others quoted, numbers and booleans bare."""

    def one(attribute: Column) -> Column:
        return (
            F.when(attribute["S"].isNotNull(), attribute["S"].cast("variant"))
            .when(attribute["N"].isNotNull(), F.try_parse_json(attribute["N"]))
            .when(attribute["BOOL"].isNotNull(), attribute["BOOL"].cast("variant"))
            .when(attribute["NUL"], F.parse_json(F.lit("null")))
            .otherwise(attribute["OTHER"].cast("variant"))
        )

    return F.when(image.isNotNull(), F.to_json(F.transform_values(image, lambda _, v: one(v))))


def decode_change_events(df: DataFrame, value: str = "value") -> DataFrame:
    """Change events as ``op``, ``key``, ``before`` and ``after`` (JSON objects, NULL when the image is absent)."""
    names = F.create_map(*[F.lit(x) for pair in OPERATIONS.items() for x in pair])
    event = F.from_json(F.col(value), EVENT_SCHEMA)
    return compute_once(
        compute_once(df, {"_event": event}),
        {
            "op": F.element_at(names, F.col("_event.eventName")),
            "key": _plain(F.col("_event.keys")),
            "before": _plain(F.col("_event.oldImage")),
            "after": _plain(F.col("_event.newImage")),
        },
    ).drop("_event")


def read_changes(df: DataFrame, stages: list = (), after: str = "after") -> DataFrame:
    """A change feed through the user's filter and projection stages, without events that carry no document."""
    df = df.filter(F.col(after).isNotNull())
    for stage in stages:
        df = stage(df)
    return df


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str], seq: str, op: str = "op") -> DataFrame:
    """Apply inserts, updates and deletes: per key only the change with the highest sequence counts.

    Knows this batch alone; ``sequence_changes`` keeps out what earlier batches have overtaken. A change
    without sequence comes before all others of its key; null keys are a key of their own.
    """
    rest = [c for c in changes.columns if c not in keys]
    last = (
        changes.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(seq)).alias("_last"))
        .select(*keys, *[F.col("_last")[c].alias(c) for c in rest])
    )
    changed = last.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    kept = target.join(changed, same, "left_anti").select(*target.columns)
    return kept.unionByName(align_columns(last.filter(F.col(op) != "delete"), target))


@dataclass
class Sequenced:
    """One batch set against the sequences known before it; see ``sequence_changes``.

    ``effective``: the changes that count, one per key, with the columns of the batch.
    ``late``: the last change of each key that came when the key could have been forgotten.
    ``sequences``: the table for the next batch: keys, _seq, _deleted, _at.
    """

    effective: DataFrame
    late: DataFrame
    sequences: DataFrame


def sequence_changes(
    sequences: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    seq: str,
    op: str = "op",
    at: str | None = None,
    keep: str | None = None,
) -> Sequenced:
    """Which changes of a batch count, given the last sequence of every key, deleted ones included.

    Per key the change with the highest sequence counts, and only if it is above the key's last
    one: an older change that comes in a later batch, or a batch that comes twice, changes nothing,
    and a deleted row stays deleted (its sequence is kept as a tombstone). A change without sequence
    counts only for a key never seen. Null keys are a key of their own.

    With ``at`` (a timestamp) and ``keep`` (an interval), tombstones whose change is older than the
    newest one seen by more than ``keep`` are forgotten; changes that old to keys not known
    are ``late``, as it cannot be told whether they were deleted since.

    Scale: the batch is reduced per key before the shuffle and joined once with the
    sequences, a row of keys and sequence each, whatever the width of the target.
    """
    rest = [c for c in changes.columns if c not in keys]
    if bool(at) != bool(keep):
        raise ValueError("give both at and keep, or none")
    change = F.struct(*[F.col(f"`{c}`") for c in rest])
    order = F.struct(
        F.coalesce(F.col(seq).cast("long"), F.lit(-(1 << 63))).alias("seq"), F.xxhash64(F.to_json(change)).alias("tie")
    )
    time = F.col(at).cast("timestamp") if at else F.lit(None).cast("timestamp")
    last = changes.groupBy(*keys).agg(
        F.max_by(F.struct(order["seq"].alias("seq"), (F.col(op) == "delete").alias("deleted"), time.alias("at"), change.alias("change")), order).alias("_new")
    )
    known = [F.struct("_seq", "_deleted", "_at").alias("_old")]
    if sequences is None:
        kinds = ", ".join(f"`{k}` {dict(changes.dtypes)[k]}" for k in keys)
        sequences = changes.sparkSession.createDataFrame([], f"{kinds}, _seq long, _deleted boolean, _at timestamp")
    old = sequences.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], *known)
    match = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    both = last.join(old, match, "full_outer")
    named = [F.when(F.col("_new").isNotNull(), F.col(f"`{k}`")).otherwise(F.col(f"_k{i}")).alias(k) for i, k in enumerate(keys)]
    both = materialise(both.select(*named, "_old", "_new"))
    horizon = None
    if at:
        newest = both.agg(F.max(F.greatest("_old._at", "_new.at"))).first()[0]
        horizon = F.lit(newest).cast("timestamp") - F.expr(f"interval {keep}")
    is_late = F.lit(False) if horizon is None else F.coalesce(F.col("_old").isNull() & (F.col("_new.at") < horizon), F.lit(False))
    newer = F.col("_new").isNotNull() & (F.col("_old").isNull() | (F.col("_new.seq") > F.col("_old._seq")))

    def plain(rows: DataFrame) -> DataFrame:
        return rows.select(*keys, *[F.col(f"_new.change.`{c}`").alias(c) for c in rest]).select(*changes.columns)

    given = F.struct(F.col("_new.seq").alias("_seq"), F.col("_new.deleted").alias("_deleted"), F.col("_new.at").alias("_at"))
    state = both.filter(~is_late).select(*keys, F.when(newer, given).otherwise(F.col("_old")).alias("_now"))
    if horizon is not None:
        state = state.filter(~F.coalesce(F.col("_now._deleted") & (F.col("_now._at") < horizon), F.lit(False)))
    return Sequenced(
        effective=plain(both.filter(newer & ~is_late)),
        late=plain(both.filter(is_late)),
        sequences=state.select(*keys, "_now.*"),
    )


def drop_replayed(df: DataFrame, partition: str | list[str], offset: str) -> DataFrame:
    """One record per source position: the batch form of stream deduplication."""
    by = [partition] if isinstance(partition, str) else list(partition)
    return df.dropDuplicates([*by, offset])
