"""Delivery: attempts, dead letters, whole records, replays."""

import glob
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from recordflow.operators import delivery as D
from recordflow.operators.model import CallFailed


def test_failed_rows_alone_are_tried_again():
    calls = []

    def sender(rows):
        calls.append([r["id"] for r in rows])
        return [i for i, r in enumerate(rows) if r["id"] == 3 or (r["id"] == 1 and len(calls) == 1)]

    how = D.Delivery(sender, retries=2, wait_seconds=0)
    assert how.send([{"id": i} for i in range(5)]) == [(3, None, 3)]
    assert calls == [[0, 1, 2, 3, 4], [1, 3], [3]]


def test_wrong_requests_are_not_tried_again():
    calls = []

    def send(row):
        calls.append(row["id"])
        if row["id"]:
            raise CallFailed({1: 404, 2: 429, 3: 500}[row["id"]], retry_after=0.0)

    failed = D.Delivery(D.one_by_one(send), retries=1, wait_seconds=0).send([{"id": i} for i in range(4)])
    assert [(i, e.status, n) for i, e, n in failed] == [(1, 404, 1), (2, 429, 2), (3, 500, 2)]
    assert calls == [0, 1, 2, 3, 2, 3]


def test_a_sender_that_raises_fails_its_run():
    def sender(rows):
        raise OSError("gone")

    failed = D.Delivery(sender, retries=0).send([{"id": 1}, {"id": 2}])
    assert [(i, str(e), n) for i, e, n in failed] == [(0, "gone", 1), (1, "gone", 1)]


def noting(folder, bad):
    def sender(rows):
        with open(f"{folder}/{uuid.uuid4().hex}.json", "w") as f:
            json.dump([r["id"] for r in rows if r["id"] % bad], f)
        return {i: ValueError(f"no {r['id']}") for i, r in enumerate(rows) if r["id"] % bad == 0}

    return sender


def received(folder):
    return sorted(i for name in glob.glob(f"{folder}/*.json") for i in json.load(open(name)))


@pytest.fixture
def rows(spark):
    return spark.range(100).select(
        "id", F.concat(F.lit("é"), "id").alias("text"), F.when(F.col("id") > 50, F.create_map(F.lit("a"), "id")).alias("attributes"),
        F.array("id", F.lit(None)).alias("list"), F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id))").alias("at"),
        F.expr("cast(id as decimal(20, 3))").alias("amount"), F.encode(F.col("id").cast("string"), "utf-8").alias("raw"),
    )


def test_a_batch_keeps_whole_failed_rows(spark, rows, tmp_path):
    inbox, dead = tmp_path / "in", f"{tmp_path}/dead"
    os.makedirs(inbox)
    D.deliver(rows.repartition(5), D.Delivery(noting(inbox, 7), size=9, retries=0, stage="s"), dead)
    letters = D.read_dead_letters(spark, dead, rows.schema)
    assert received(inbox) == [i for i in range(100) if i % 7]
    want = {r.id: r for r in rows.filter("id % 7 = 0").collect()}
    found = letters.collect()
    assert {r.id: r[: len(rows.columns)] for r in found} == {i: tuple(r) for i, r in want.items()} and len(found) == len(want)
    assert {(r.error_message, r.error_class, r.stage, r.attempts) for r in found if r.id == 14} == {("no 14", "ValueError", "s", 1)}
    # A second job adds its own letters; one without failures or rows adds none.
    D.deliver(rows.filter("id < 8"), D.Delivery(noting(inbox, 7), retries=0), dead)
    D.deliver(rows.filter("id = 1"), D.Delivery(noting(inbox, 7), retries=0), dead)
    D.deliver(rows.filter("false"), D.Delivery(noting(inbox, 7), retries=0), dead)
    assert D.read_dead_letters(spark, dead, rows.schema).count() == len(want) + 2
    assert glob.glob(f"{dead}/_staged/*") == []


def test_a_folder_without_letters_is_empty(spark, rows, tmp_path):
    assert D.read_dead_letters(spark, f"{tmp_path}/none", rows.schema).collect() == []


def test_a_repeated_micro_batch_replaces_its_letters(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    inbox, dead = tmp_path / "in", f"{tmp_path}/dead"
    os.makedirs(inbox)
    schema = _parse_datatype_string("id bigint")
    spark.range(20).write.parquet(f"{tmp_path}/log")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/log")
    for state in ("a", "b"):  # a lost checkpoint: micro-batch 0 comes again
        handle = D.deliver_stream(stream, D.Delivery(noting(inbox, 5), retries=0), dead, f"{tmp_path}/{state}")
        handle.awaitTermination()
        assert handle.exception() is None
    assert sorted(r.id for r in D.read_dead_letters(spark, dead, schema).collect()) == [0, 5, 10, 15]
    assert received(inbox) == sorted([i for i in range(20) if i % 5] * 2)
