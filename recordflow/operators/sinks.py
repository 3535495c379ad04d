"""Rendering of outgoing records, chunked sending, bulk-load staging and fan-out."""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import render_url
from .model import CallFailed
from .staging import positions

# Fixed value: most records one put request may carry.
PUT_LIMIT = 500


def with_target(df: DataFrame, target: str) -> DataFrame:
    """Adds ``target``; ``{column}`` in the name is filled per record."""
    pieces = re.split(r"\{([^}]+)\}", target)
    parts = [F.col(p).cast("string") if i % 2 else F.lit(p) for i, p in enumerate(pieces) if i % 2 or p]
    return df.withColumn("target", F.concat(*parts))


def with_headers(df: DataFrame, headers: dict[str, Column]) -> DataFrame:
    """Adds ``headers`` as text; headers without a value are left out."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in headers.items()])
    return df.withColumn("headers", F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull())))


def stream_fields(df: DataFrame) -> DataFrame:
    """The field map of one appended log entry: value, key if any, and ``header.*``."""
    fixed = F.map_filter(
        F.create_map(F.lit("value"), F.col("value"), F.lit("key"), F.col("key").cast("string")),
        lambda _, v: v.isNotNull(),
    )
    named = F.transform_keys("headers", lambda k, _: F.concat(F.lit("header."), k))
    return df.withColumn("fields", F.when(F.col("headers").isNull(), fixed).otherwise(F.map_concat(fixed, named)))


def chunk(df: DataFrame, order: list[str], size: int = PUT_LIMIT, constant_key: str = "record") -> DataFrame:
    """Numbered runs of at most ``size`` records, with the partition key of each record."""
    return (
        positions(df, order)
        .withColumn("chunk", F.floor(F.col("_pos") / size))
        .withColumn(
            "partition_key",
            F.when(F.length("key") > 0, F.col("key").cast("string")).otherwise(F.lit(constant_key)),
        )
        .drop("_pos")
    )


def _runs(rows: Iterable, size: int):
    held = []
    for row in rows:
        held.append(row.asDict(recursive=True))
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def put_chunks(
    df: DataFrame,
    sender: Callable[[list[dict]], list[int]],
    size: int = PUT_LIMIT,
    retries: int = 3,
    wait_seconds: float = 0.1,
) -> None:
    """Send every partition in runs of ``size``; only the failed records of a run are sent again.

    ``sender`` returns the positions that failed. A run that still fails raises,
    so that Spark repeats the task: delivery is at least once.
    """

    def send(rows) -> None:
        for pending in _runs(rows, size):
            for attempt in range(retries + 1):
                failed = sender(pending)
                if not failed:
                    break
                if attempt == retries:
                    raise RuntimeError(f"{len(failed)} records failed after {retries + 1} attempts")
                pending = [pending[i] for i in failed]
                time.sleep(wait_seconds * 2**attempt)

    df.foreachPartition(send)


def render_requests(df: DataFrame, template: str, method: str = "POST", value: str = "value") -> DataFrame:
    """One outgoing request per record: address from the template, the record as body."""
    return df.withColumns(
        {"url": render_url(template, F.col(value)), "method": F.lit(method), "body": F.col(value)}
    )


def send_requests(
    requests: DataFrame, send_fn: Callable[[dict], None], retries: int = 5, wait_seconds: float = 0.5
) -> None:
    """Send one request per row; overload (429) and server errors are retried, honouring a given wait."""

    def send(rows) -> None:
        for row in rows:
            request = row.asDict(recursive=True)
            for attempt in range(retries):
                try:
                    send_fn(request)
                    break
                except CallFailed as failure:
                    if attempt + 1 == retries or not (failure.status == 429 or failure.status >= 500):
                        raise
                    wait = failure.retry_after if failure.retry_after is not None else wait_seconds * 2**attempt
                    time.sleep(wait * (1 + 0.25 * random.random()))

    requests.foreachPartition(send)


def stage_ndjson(df: DataFrame, path: str, value: str = "value") -> None:
    """Newline-delimited JSON files, one per partition, for a bulk load."""
    df.filter(F.col(value).isNotNull()).select(F.col(value).alias("value")).write.mode("error").text(path)


def load_statement(kind: str, table: str, path: str, *, role: str = "", region: str = "") -> str:
    """The statement that loads staged files: copy (COPY of JSON files) or json_column (one JSON column)."""
    if not re.fullmatch(r'[A-Za-z_"][A-Za-z0-9_."$]*', table):
        raise ValueError(f"not a table name: {table}")
    if "'" in path + role + region:
        raise ValueError("quotes are not allowed in a load statement")
    if kind == "copy":
        return f"COPY {table} FROM '{path}' IAM_ROLE '{role}' FORMAT AS JSON 'auto' REGION '{region}'"
    if kind == "json_column":
        return f"INSERT INTO {table} SELECT PARSE_JSON($1) FROM '{path}'"
    raise ValueError(f"unknown load kind: {kind}")


def load_rows(df: DataFrame, kind: str, columns: dict[str, str] | None = None, value: str = "value") -> DataFrame:
    """Rows as a warehouse receives them: one JSON text column, or typed columns for a row append."""
    from .merge import records_to_rows

    if kind in ("copy", "json_column"):
        return df.filter(F.col(value).isNotNull()).select(F.col(value).alias("payload"))
    return records_to_rows(df, columns or {}, value).select(*(columns or {}))


def fan_out(df: DataFrame, sinks: dict[str, Callable[[DataFrame], None]]) -> None:
    """Write one transformed set to several sinks; it is computed once."""
    df.persist()
    try:
        for write in sinks.values():
            write(df)
    finally:
        df.unpersist()


def write_jdbc_upsert(
    df: DataFrame, url: str, table: str, columns: list[str], keys: list[str], staging: str, **options
) -> str:
    """Stage the rows with Spark's JDBC writer and return the one MERGE statement to run on the database."""
    writer = df.select(*columns).write.format("jdbc").option("url", url).option("dbtable", staging)
    for name, setting in options.items():
        writer = writer.option(name, setting)
    writer.mode("overwrite").save()
    return merge_statement(table, staging, columns, keys)


def merge_statement(table: str, staging: str, columns: list[str], keys: list[str]) -> str:
    """MERGE of a staging table by key: overwrite the other columns or insert; keys only: insert what is new."""
    quoted = {c: '"' + c.replace('"', '""') + '"' for c in columns}
    on = " AND ".join(f"t.{quoted[k]} = s.{quoted[k]}" for k in keys)
    sets = ", ".join(f"{quoted[c]} = s.{quoted[c]}" for c in columns if c not in keys)
    matched = f" WHEN MATCHED THEN UPDATE SET {sets}" if sets else ""
    names = ", ".join(quoted[c] for c in columns)
    values = ", ".join(f"s.{quoted[c]}" for c in columns)
    return (
        f"MERGE INTO {table} t USING {staging} s ON {on}{matched}"
        f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )
