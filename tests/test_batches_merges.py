import json

import pytest
from pyspark.sql import functions as F

from recordflow.operators import batching as B
from recordflow.operators import changes as CH
from recordflow.operators import merge as M
from recordflow.operators import records as R
from recordflow.operators import sinks as S
from recordflow.operators.staging import running_max
from recordflow.sources import incremental as I


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_batches_do_not_depend_on_partitioning(spark, parts):
    df = spark.range(1000).selectExpr("id", "case when id % 3 = 0 then 7 else id % 13 end k").repartition(parts)
    out = B.assign_batches(df, ["k", "id"], 64).orderBy("k", "id").collect()
    assert [(r["batch_id"], r["ordinal"]) for r in out] == [(i // 64, i % 64) for i in range(1000)]


def test_sub_batches(spark):
    df = spark.range(10).selectExpr("0L batch_id", "cast(id as int) ordinal")
    got = [r["sub_batch"] for r in B.split_batches(df, 3).orderBy("ordinal").collect()]
    assert got == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]
    assert {r["sub_batch"] for r in B.split_batches(df, 10).collect()} == {0}


def test_serialized_batch(spark):
    df = spark.sql(
        "select 1 batch_id, 1 ordinal, 'b' key, '{\"x\":1}' value, map('m','1') metadata union all "
        "select 1, 0, null, null, cast(map() as map<string,string>)"
    )
    assert json.loads(B.serialize_batches(df).first()["batch_json"]) == [{}, {"key": "b", "value": '{"x":1}', "metadata": {"m": "1"}}]


def test_running_max_with_a_hot_key(spark):
    df = spark.range(3000).selectExpr("id", "case when id % 3 < 2 then 0 else id % 7 end k", "(id * 7919) % 1009 v")
    got = {r["id"]: r["top"] for r in running_max(df, ["k"], ["id"], "v", "top").collect()}
    best, rows = {}, sorted((r["id"], r["k"], r["v"]) for r in df.collect())
    for i, k, v in rows:
        best[k] = max(best.get(k, v), v)
        assert got[i] == best[k]


def test_replay_ids_with_a_hot_channel(spark):
    df = spark.range(2000).selectExpr(
        "id", "case when id % 3 < 2 then 0 else id % 5 end ch",
        "case when id % 17 = 4 then concat('{\"event\":{\"replayId\":', id * 10, '}}') when id % 17 = 5 then '{\"event\":{\"replayId\":\"7\"}}' else '{}' end value",
    )
    got = {r["id"]: r["replay_id"] for r in R.assign_replay_ids(df, ["ch"], ["id"]).collect()}
    last = {}
    for i in range(2000):
        ch = 0 if i % 3 < 2 else i % 5
        last[ch] = i * 10 if i % 17 == 4 else last.get(ch, 0) + 1
        assert got[i] == last[ch]


def test_pages_cover_the_table(spark):
    df = spark.range(100).selectExpr("id", "timestamp_seconds(id div 7) ts")
    seen, offset = [], None
    while True:
        page = I.read_incremental(df, "timestamp+incrementing", "ts", "id", offset, limit=9)
        rows = page.collect()
        if not rows:
            break
        seen += [r["id"] for r in rows]
        offset = I.next_offset(page, "timestamp+incrementing", "ts", "id").first().asDict()
    assert seen == list(range(100))


def test_offset_with_one_part_missing(spark):
    df = spark.range(10).selectExpr("id", "timestamp_seconds(id) ts")
    only_id = I.read_incremental(df, "timestamp+incrementing", "ts", "id", {"id": 6})
    assert [r["id"] for r in only_id.collect()] == [7, 8, 9]


def test_upsert_is_idempotent(spark):
    target = spark.range(20).selectExpr("id", "'old' v", "1 w")
    changes = spark.sql("select id % 15 + 10 id, concat('n', id) v, cast(id as int) w, id seq from range(60)")
    once = M.merge_upsert(target, changes, ["id"], "seq")
    twice = M.merge_upsert(once, changes, ["id"], "seq")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.filter("id = 10").first()["v"] == "n45" and once.count() == 25


def test_column_merge(spark):
    target = spark.sql("select 1 id, 'a' x, 5.0D y union all select 2, 'b', 6.0D")
    changes = spark.createDataFrame(
        [(1, 0, '{"x":"new"}'), (1, 1, '{"y":null}'), (3, 2, '{"y":7}'), (2, 3, '{"other":1}')], "id int, seq int, value string"
    )
    got = {r["id"]: (r["x"], r["y"]) for r in M.merge_columns(target, changes, ["id"], "seq").collect()}
    assert got == {1: ("new", None), 2: ("b", 6.0), 3: (None, 7.0)}


def test_nested_value_keeps_its_text(spark):
    row = M.records_to_rows(spark.sql("""select '{"a":{"b":1},"n":"x","i":5}' value"""), {"a": "string", "n": "bigint", "i": "string"}).first()
    assert (json.loads(row["a"]), row["n"], row["i"]) == ({"b": 1}, None, "5")


def test_change_events(spark):
    item = {"id": {"N": "5"}, "s": {"S": 'q"'}, "b": {"BOOL": True}, "z": {"NUL": True}, "o": {"OTHER": "raw"}}
    rows = [
        (0, json.dumps({"eventName": "INSERT", "newImage": item, "keys": {"id": {"N": "5"}}})),
        (1, json.dumps({"eventName": "REMOVE", "oldImage": item, "keys": {"id": {"N": "5"}}})),
    ]
    out = CH.decode_change_events(spark.createDataFrame(rows, "seq int, value string")).orderBy("seq").collect()
    assert [r["op"] for r in out] == ["insert", "delete"]
    assert json.loads(out[0]["after"]) == {"id": 5, "s": 'q"', "b": True, "z": None, "o": "raw"}
    assert out[0]["before"] is None and out[1]["after"] is None


def test_changes_out_of_order(spark):
    target = spark.sql("select 1 id, 'a' v union all select 2, 'b'")
    changes = spark.sql(
        "select * from values (1, 'x', 'update', 5), (1, null, 'delete', 9), (2, 'y', 'update', 3), (2, 'z', 'update', 2), (3, 'n', 'insert', 1) as t(id, v, op, seq)"
    )
    assert sorted(tuple(r) for r in CH.apply_changes(target, changes, ["id"], "seq").collect()) == [(2, "y"), (3, "n")]


# --------------------------------------------------------------------- sinks


def test_only_failed_records_are_sent_again(spark, tmp_path):
    log = str(tmp_path / "sent.txt")

    def sender(rows):
        with open(log, "a") as f:
            f.write(json.dumps([r["id"] for r in rows]) + "\n")
        with open(log) as f:
            first_time = sum(1 for _ in f) <= 2
        return [i for i, r in enumerate(rows) if r["id"] % 10 == 3] if first_time else []

    S.put_chunks(spark.range(0, 20, 1, 1), sender, size=20, wait_seconds=0.0)
    sent = [json.loads(x) for x in open(log)]
    assert [len(s) for s in sent] == [20, 2, 2] and sent[1] == [3, 13]


def test_failing_chunk_raises(spark):
    with pytest.raises(Exception, match="failed after 2 attempts"):
        S.put_chunks(spark.range(3), lambda rows: [0], retries=1, wait_seconds=0.0)


def test_statements():
    assert S.merge_statement("T", "S", ["id", "v"], ["id"]) == (
        'MERGE INTO T t USING S s ON t."id" = s."id" WHEN MATCHED THEN UPDATE SET "v" = s."v"'
        ' WHEN NOT MATCHED THEN INSERT ("id", "v") VALUES (s."id", s."v")'
    )
    assert "UPDATE" not in S.merge_statement("T", "S", ["a", "b"], ["a", "b"])
    assert S.load_statement("copy", "t", "s3://x/y", role="r", region="e").startswith("COPY t FROM 's3://x/y' IAM_ROLE 'r'")
    with pytest.raises(ValueError):
        S.load_statement("copy", "t; drop", "p")


def test_headers_and_targets(spark):
    df = spark.sql("select 'k' key, 'v' value, 5 n union all select null, 'w', null")
    out = S.with_target(S.stream_fields(S.with_headers(df, {"n": F.col("n")})), "t.{value}").orderBy("value").collect()
    assert [r["fields"] for r in out] == [{"key": "k", "value": "v", "header.n": "5"}, {"value": "w"}]
    assert [r["target"] for r in out] == ["t.v", "t.w"]
