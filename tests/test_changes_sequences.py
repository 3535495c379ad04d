"""Change apply between batches: sequences, tombstones and their expiry."""

import random

import pytest
from pyspark.sql import functions as F

from recordflow.operators import changes as CH

def changes(spark, *rows):
    return spark.createDataFrame(
        [(i, s, o, None if m is None else f"2024-01-01 00:{m:02d}:00", a, "clash") for i, s, o, m, a in rows],
        "id long, seq long, op string, at string, amount long, _other string",
    ).withColumn("at", F.col("at").cast("timestamp"))


def rows(df):
    return sorted(((r.id, r.seq, r.op) for r in df.collect()), key=str)


def run(spark, batches, keep=None):
    known, target, late = None, spark.createDataFrame([], "id long, amount long"), []
    for batch in batches:
        done = CH.sequence_changes(known, batch, ["id"], "seq", at="at" if keep else None, keep=keep)
        target = CH.apply_changes(target, done.effective, ["id"], "seq")
        late += rows(done.late)
        known = spark.createDataFrame(done.sequences.collect(), done.sequences.schema)
        target = spark.createDataFrame(target.collect(), target.schema)
    return {r.id: r.amount for r in target.collect()}, late, known


def test_a_deleted_row_stays_deleted(spark):
    first = changes(spark, (1, 5, "delete", None, None), (2, 1, "insert", None, 10))
    second = changes(spark, (1, 3, "update", None, 7), (2, 1, "insert", None, 10), (3, None, "insert", None, 1))
    third = changes(spark, (1, 6, "insert", None, 8), (3, None, "update", None, 2), (None, 1, "insert", None, 4), (None, 2, "update", None, 5))
    target, late, known = run(spark, [first, second, third, first, second, third])
    assert target == {1: 8, 2: 10, 3: 1, None: 5} and late == []
    assert {(r.id, r._seq, r._deleted) for r in known.collect()} == {(1, 6, False), (2, 1, False), (3, -(1 << 63), False), (None, 2, False)}


def test_any_order_of_batches_gives_the_last_state(spark):
    rng = random.Random(5)
    events = [(rng.randrange(12), s, rng.choice(["insert", "update", "delete"]), None, s) for s in range(120)]
    last = {i: (o, a) for i, _, o, _, a in events}
    want = {i: a for i, (o, a) in last.items() if o != "delete"}
    shuffled = rng.sample(events, len(events))
    parts = [changes(spark, *shuffled[i::3]) for i in range(3)]
    assert run(spark, [*parts, *parts[::-1]])[0] == want


def test_tombstones_expire_and_older_changes_are_late(spark):
    first = changes(spark, (1, 5, "delete", 0, None), (2, 1, "insert", 1, 10))
    second = changes(spark, (3, 9, "insert", 30, 1))
    # Key 1 is forgotten by now: its old change cannot be told from one that was deleted since.
    third = changes(spark, (1, 3, "update", 2, 7), (2, 2, "update", 2, 11), (4, 1, "insert", 29, 3))
    target, late, known = run(spark, [first, second, third], "10 minutes")
    assert target == {2: 11, 3: 1, 4: 3} and late == [(1, 3, "update")]
    assert {r.id for r in known.collect()} == {2, 3, 4}


def test_empty_batches_and_wrong_options(spark):
    none = changes(spark, (1, 1, "insert", 0, 1)).filter("false")
    done = CH.sequence_changes(None, none, ["id"], "seq", at="at", keep="1 day")
    assert done.effective.collect() == done.late.collect() == done.sequences.collect() == []
    assert done.effective.columns == none.columns
    with pytest.raises(ValueError):
        CH.sequence_changes(None, none, ["id"], "seq", keep="1 day")
