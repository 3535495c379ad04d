"""Record envelopes, and the shapes that different sources deliver records in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V
from .staging import compute_once, fill_sequence, materialise

ENVELOPE = (
    "key string, value string, metadata map<string,string>, "
    "src_partition map<string,string>, src_offset map<string,string>"
)


def empty_map() -> Column:
    return F.from_json(F.lit("{}"), "map<string,string>")


def text_map(pairs: dict[str, Column | str]) -> Column:
    """A map<string,string> of named columns or constants; without pairs an empty map."""
    if not pairs:
        return empty_map()
    flat: list[Column] = []
    for name, value in pairs.items():
        flat += [F.lit(name), (value if isinstance(value, Column) else F.lit(str(value))).cast("string")]
    return F.create_map(*flat)


def to_envelope(
    df: DataFrame,
    key_cols: list[str] | None = None,
    metadata: dict[str, Column | str] | None = None,
    offset_cols: list[str] | None = None,
    partition: dict[str, Column | str] | None = None,
) -> DataFrame:
    """Typed rows as records: the row as a JSON object with its nulls kept, a key and metadata."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols]) if key_cols else F.lit(None).cast("string")
    return df.select(
        key.alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"),
        text_map(metadata or {}).alias("metadata"),
        text_map(partition or {}).alias("src_partition"),
        text_map({c: F.col(c) for c in offset_cols or []}).alias("src_offset"),
    )


def read_many(tables: dict[str, DataFrame]) -> DataFrame:
    """Several tables as one, columns matched by name, with ``source_table`` telling where a row is from."""
    frames = [df.withColumn("source_table", F.lit(name)) for name, df in tables.items()]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def union_sources(*frames: DataFrame) -> DataFrame:
    """Records of several connectors as one stream of records."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def unwrap_samples(df: DataFrame, value: str = "value") -> DataFrame:
    """``{key, value, ...}`` wrappers of at most three fields give the record inside, others stay."""
    df = compute_once(df, {"_parsed": V.parse(F.col(value))})
    parsed = F.col("_parsed")
    inner = V.text_of(V.field(parsed, "value"))
    wrapped = (
        V.field(parsed, "value").isNotNull()
        & V.field(parsed, "key").isNotNull()
        & (F.size(F.json_object_keys(value)) <= 3)
        & V.parse(inner).isNotNull()
    )
    unwrapped = F.when(F.coalesce(wrapped, F.lit(False)), inner).otherwise(F.col(value))
    return compute_once(df, {value: unwrapped}).drop("_parsed")


def extract_records(pages: DataFrame, content_path: str = "", body: str = "body", url: str = "url") -> DataFrame:
    """One record per element of the array at ``content_path``; anything else is one record of the whole body.

    A list without elements gives no record. Adds ``item`` (position in the page)
    and ``value``, and puts the address into ``metadata``.
    """
    root = V.parse(F.col(body))
    for part in content_path.split(".") if content_path else []:
        root = V.field(root, part)
    items = F.try_variant_get(root, "$", "array<variant>")
    texts = F.when(items.isNull(), F.array(F.col(body))).otherwise(F.transform(items, lambda v: F.to_json(v)))
    return (
        pages.withColumn("_items", texts)
        .select("*", F.posexplode("_items").alias("item", "value"))
        .withColumn("metadata", text_map({"source.url": F.col(url)}))
        .drop("_items", body)
    )


def entries_to_records(df: DataFrame, dn: str = "dn", attribute: str = "attribute", value: str = "value") -> DataFrame:
    """Directory entries from (dn, attribute, value) rows: one value becomes a scalar, several an array."""
    per_attribute = df.groupBy(dn, attribute).agg(F.array_sort(F.collect_list(F.col(value).cast("string"))).alias("_all"))
    as_value = F.when(F.size("_all") == 1, V.to_variant(F.get("_all", 0))).otherwise(
        F.parse_json(F.to_json("_all"))
    )
    return (
        per_attribute.withColumn("_v", as_value)
        .groupBy(dn)
        .agg(F.map_from_entries(F.collect_list(F.struct(F.col(attribute), F.col("_v")))).alias("_attrs"))
        .select(
            F.col(dn).alias("key"),
            F.to_json(
                F.map_concat(F.create_map(F.lit("dn"), V.to_variant(F.col(dn))), F.col("_attrs"))
            ).alias("value"),
            text_map({"source.dn": F.col(dn)}).alias("metadata"),
        )
    )


def entries_since(df: DataFrame, changed: str, last: str | int | None) -> DataFrame:
    """Inclusive resume on a modification mark: rows after it, and the rows at it once each (they may be read twice)."""
    if last is None:
        return df
    mark = F.lit(last)
    return df.filter(F.col(changed) > mark).unionByName(df.filter(F.col(changed) == mark).distinct())


def result_tables_or_params(tables: DataFrame, params: DataFrame, call: str = "call_id") -> DataFrame:
    """Rows of a call's result tables; a call without any gives one record of its scalar parameters.

    ``tables`` has (call, table_name, row_no, name, value) cells, ``params`` has (call, name, value) cells.
    """
    cells = F.map_from_entries(F.collect_list(F.struct("name", F.col("value").cast("string"))))
    rows = tables.groupBy(call, "table_name", "row_no").agg(F.to_json(cells).alias("value"))
    silent = params.join(rows.select(call).distinct(), call, "left_anti")
    scalars = silent.groupBy(call).agg(F.to_json(cells).alias("value"))
    return rows.unionByName(scalars, allowMissingColumns=True).select(call, "table_name", "row_no", "value")


def log_entries_to_records(
    df: DataFrame, entry_id: str = "entry_id", fields: str = "fields", log: Column | str = "log"
) -> DataFrame:
    """Entries of an append-only log: the field map as a JSON object, the entry id as key and offset."""
    return df.select(
        F.col(entry_id).cast("string").alias("key"),
        F.to_json(fields).alias("value"),
        text_map({"source.log": log, "source.entryId": F.col(entry_id)}).alias("metadata"),
        text_map({"log": log}).alias("src_partition"),
        text_map({"entryId": F.col(entry_id)}).alias("src_offset"),
    )


def topic_envelope(df: DataFrame) -> DataFrame:
    """Rows of Spark's Kafka source (key, value, topic, partition, offset, timestamp) as records."""
    place = {n: F.col(n) for n in ("topic", "partition", "offset")}
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        text_map({f"source.{n}": c for n, c in place.items()}).alias("metadata"),
        text_map({"topic": place["topic"], "partition": place["partition"]}).alias("src_partition"),
        text_map({"offset": place["offset"]}).alias("src_offset"),
    )


def assign_replay_ids(
    df: DataFrame, channel: list[str], order: list[str], payload: str = "value", out: str = "replay_id"
) -> DataFrame:
    """``event.replayId`` where it is a number, else one more than the id before, per channel."""
    found = V.json_path(V.parse(F.col(payload)), "$.event.replayId")
    number = F.when(V.kind(found).isin("integer", "number"), F.try_variant_get(found, "$", "double").cast("bigint"))
    return fill_sequence(df.withColumn("_given", number), channel, order, "_given", out).drop("_given")


def continue_replay_ids(
    df: DataFrame, known: DataFrame | None, channel: list[str], order: list[str], payload: str = "value", out: str = "replay_id"
) -> tuple[DataFrame, DataFrame]:
    """``assign_replay_ids`` over micro-batches: (records with ids, last id per channel after them).

    ``known`` holds the channel columns and ``last_id`` as returned for the batch before (None at first); store the
    second frame before the next batch. Each channel starts from its last id, which goes in front of its records
    as one more row with an id of its own; so a channel with a third of all records still spreads over ranges. Null
    channels are a channel. Channels without records in the batch keep their id; an empty batch returns ``known``.
    """
    found = V.json_path(V.parse(F.col(payload)), "$.event.replayId")
    number = F.when(V.kind(found).isin("integer", "number"), F.try_variant_get(found, "$", "double").cast("bigint"))
    given = df.withColumns({"_given": number, "_later": F.lit(1)})
    if known is not None:
        front = known.select(*channel, F.col("last_id").alias("_given"), F.lit(0).alias("_later"))
        given = given.unionByName(front, allowMissingColumns=True)
    # Names of channels as one text, since a null one joins and groups with nothing in ranges.
    keyed = given.withColumn("_channel", F.to_json(F.struct(*channel)))
    done = materialise(fill_sequence(keyed, ["_channel"], ["_later", *order], "_given", out))
    last = done.groupBy(*channel).agg(F.max_by(out, F.struct("_later", *order)).alias("last_id"))
    return done.filter("_later = 1").drop("_given", "_later", "_channel"), last
