import json
import os
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from recordflow.functions import variant as V
from recordflow.operators import accounting as A
from recordflow.operators import model as L
from recordflow.operators import reuse as U
from recordflow.operators.contract import Contract
from recordflow.plans.config import BatchOptions, CallOptions, FlowConfig, MaskOptions, ReuseOptions, RouterOptions
from recordflow.plans.flow import Pipeline
from recordflow.sources.crawl import crawl, fetch_with
from recordflow.streaming import runner


cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Logged:
    """Counts calls in a file, as calls happen in other processes."""

    def __init__(self, path, answer):
        self.path, self.answer = str(path), answer

    def call(self, request):
        with open(self.path, "a") as f:
            f.write(request["user_prompt"].replace("\n", " ") + "\n")
        return self.answer(request)

    @property
    def calls(self):
        return open(self.path).read().splitlines() if os.path.exists(self.path) else []


def rename(request):
    batch = json.loads(request["user_prompt"].split("\n", 1)[1])
    outputs = []
    for item in batch:
        record = json.loads(item["value"])
        outputs.append({"order_key": record["orderKey"], "ship_mode": record["shipMode"]})
    return {"content": json.dumps(outputs), "model": "claude-haiku-x", "input_tokens": 1000, "output_tokens": 500}


def test_equal_requests_share_a_call(spark, tmp_path):
    client = Logged(tmp_path / "log", lambda r: {"content": "[1]", "model": "m"})
    df = spark.range(50).selectExpr("id", "concat('p', id % 3) user_prompt")
    assert L.complete(df, client).filter("content = '[1]'").count() == 50
    assert len(client.calls) == 3
    stored = str(tmp_path / "answers")
    L.complete(df, client, log_path=stored).count()
    L.complete(df, client, log_path=stored).count()
    assert len(client.calls) == 6


def test_malformed_answers_get_a_correction(spark, tmp_path):
    client = Logged(tmp_path / "log", lambda r: {"content": "[2]" if r["user_prompt"] == "fix" else "sorry", "input_tokens": 3})
    df = spark.sql("select 'ask' user_prompt, 'fix' correction_prompt")
    row = L.complete(df, client, wait_seconds=0.0).first()
    assert (row["content"], row["attempts"], row["input_tokens"], row["call_error"]) == ("[2]", 2, 6, None)
    bad = L.complete(df, Logged(tmp_path / "l2", lambda r: {"content": "no"}), max_retries=1, wait_seconds=0.0).first()
    assert (bad["content"], bad["attempts"], bad["call_error"]) == (None, 2, "malformed output")


def test_overload_is_retried(spark, tmp_path):
    log = tmp_path / "log"

    def answer(request):
        if len(open(log).read().splitlines()) < 3:
            raise L.CallFailed(429, "busy", 0.0)
        return {"content": "[]"}

    assert L.complete(spark.sql("select 'x' user_prompt"), Logged(log, answer)).first()["content"] == "[]"

    def refuse(request):
        raise L.CallFailed(400, "bad request")

    row = L.complete(spark.sql("select 'x' user_prompt"), Logged(tmp_path / "l3", refuse)).first()
    assert row["call_error"].startswith("CallFailed") and row["content"] is None


def test_costs(spark):
    calls = spark.sql(
        "select * from values ('claude-sonnet-4', 1000L, 500L), ('claude-haiku-3', 10000L, 2000L), ('other', 5L, 5L), (null, 5L, 5L), ('GPT-4o-Mini', 1000000L, 0L) as t(model, input_tokens, output_tokens)"
    ).selectExpr("*", "0L cache_create_tokens", "0L cache_read_tokens")
    got = [round(r["cost_usd"], 6) for r in A.call_cost(calls).collect()]
    assert got == [0.0105, 0.005, 0.0, 0.0, 0.15]
    cached = spark.sql("select 'gpt-4o' model, 1000000L input_tokens, 0L output_tokens, 0L cache_create_tokens, 400000L cache_read_tokens")
    assert A.call_cost(cached).first()["cost_usd"] == pytest.approx(3.5)
    assert A.call_cost(cached, includes_cached=("gpt-4o",)).first()["cost_usd"] == pytest.approx(2.5)


# --------------------------------------------------------- similarity cache


@pytest.mark.parametrize("threshold", [0.3, 0.9, 0.97])
def test_lookup_equals_brute_force(spark, threshold):
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(12, 16))
    entries = (centers[rng.integers(0, 12, 400)] + 0.25 * rng.normal(size=(400, 16))).astype(np.float32)
    asked = (centers[rng.integers(0, 12, 150)] + 0.25 * rng.normal(size=(150, 16))).astype(np.float32)
    asked[:50] = entries[3]  # a third of all queries are the same
    entries[:130] = entries[3]  # and a third of all entries
    entry_rows = [(i, e.tolist(), f"o{i}", 1_700_000_000 + i % 5) for i, e in enumerate(entries)]
    cache = spark.createDataFrame(entry_rows, "cache_id long, embedding array<float>, output string, s long").withColumn("created_at", F.timestamp_seconds("s")).drop("s")
    queries = spark.createDataFrame([(i, q.tolist()) for i, q in enumerate(asked)], "query_id long, embedding array<float>")
    out = U.cache_lookup(queries, cache, threshold, cache_block=64, query_block=32).orderBy("query_id").collect()
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = unit(asked.astype(np.float64)) @ unit(entries.astype(np.float64)).T
    assert len(out) == 150
    for row, line in zip(out, scores):
        if line.max() < threshold - 1e-6:
            assert not row["hit"] and row["output"] is None
        elif line.max() > threshold + 1e-6:
            assert row["hit"] and row["similarity"] == pytest.approx(line.max(), abs=1e-6)
            assert line[row["cache_id"]] == pytest.approx(line.max(), abs=1e-6)
    assert {r["cache_id"] for r in out[:50]} == {4}  # newest of the equal entries, then smallest id


def test_empty_cache(spark):
    cache = spark.createDataFrame([], "cache_id long, embedding array<float>, output string, created_at timestamp")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<float>")
    assert not U.cache_lookup(queries, cache, 0.9).first()["hit"]


# ------------------------------------------------------------------- specs


def test_spec_log(spark):
    log = spark.createDataFrame(
        [("a", "old", 1), ("a", "new", 5), ("b", "x", 2), ("c", "y", 4)], "fingerprint string, code string, s int"
    ).selectExpr("fingerprint", "'DECLARATIVE' type", "code", "timestamp_seconds(s) created_at", "'m' model")
    at = F.expr("timestamp_seconds(10)")
    live = lambda *a: {r["fingerprint"]: r["code"] for r in U.live_specs(log, *a).collect()}
    assert live() == {"a": "new", "b": "x", "c": "y"}
    assert live(6, at) == {"a": "new", "c": "y"}
    gone = spark.sql("select 'a' fingerprint, timestamp_seconds(6) invalidated_at union all select 'c', timestamp_seconds(3)")
    assert live(-1, at, gone) == {"b": "x", "c": "y"}


def test_mapping_as_data_equals_unrolled(records, read):
    spec = {
        "mappings": {"a": "$.x.y", "b": "items[1].k", "c": "$.gone", "w": "", "n": "$.n"},
        "defaults": {"d": [1], "a": 0, "n": 2},
        "typeCasts": {"b": "integer", "a": "string"},
    }
    rows = records({"x": {"y": 1.5}, "items": [{}, {"k": "7"}], "n": None}, {"x": 1})
    unrolled = read(rows.withColumn("value", U.mapped(V.parse(F.col("value")), spec)))
    by_data = read(rows.withColumn("value", U._mapped_by_data(V.parse(F.col("value")), U._prepared(F.lit(json.dumps(spec))))))
    assert unrolled == by_data
    assert unrolled[0]["b"] == 7 and unrolled[0]["a"] == "1.5" and unrolled[0]["n"] is None


# -------------------------------------------------------------------- flow

TARGET = json.dumps({"type": "object", "properties": {"order_key": {"type": "string"}, "ship_mode": {"type": "string"}}})


def users(records, n=10, **extra):
    return records(*[{"orderKey": f"u{i % 6}", "shipMode": f"u{i % 6}@x.org", **extra} for i in range(n)])


def flow_config(**kw):
    return FlowConfig(contract=TARGET, batches=BatchOptions(size=4), calls=CallOptions(max_retries=0, wait_seconds=0.0), **kw)


def test_second_run_makes_no_calls(records, tmp_path):
    client = Logged(tmp_path / "log", rename)
    config = flow_config(reuse=ReuseOptions(cache_path=str(tmp_path / "cache")))
    first = Pipeline(config, client).transform(users(records))
    assert first.good.count() == 10 and first.quarantine.count() == 0
    assert {r["route"] for r in first.good.collect()} == {"model"}
    made = len(client.calls)
    again = Pipeline(config, client).transform(users(records, 12))
    got = again.good.orderBy("key").collect()
    assert {r["route"] for r in got} == {"cache"} and len(client.calls) == made
    assert sorted(json.loads(r["value"])["order_key"] for r in got) == sorted(f"u{i % 6}" for i in range(12))


def test_equal_records_are_asked_once_and_restored_each(records, tmp_path):
    client = Logged(tmp_path / "log", rename)
    config = flow_config(masking=MaskOptions(fields=("orderKey", "shipMode")))
    result = Pipeline(config, client).transform(users(records))
    # All records look alike once masked, so one is sent; every record gets its own values back.
    assert len(client.calls) == 1 and "exactly 1 " in client.calls[0] and "x.org" not in client.calls[0]
    got = {r["key"]: json.loads(r["value"]) for r in result.good.collect()}
    assert got == {f"k{i}": {"order_key": f"u{i % 6}", "ship_mode": f"u{i % 6}@x.org"} for i in range(10)}
    assert result.calls.agg(F.sum("cost_usd")).first()[0] == pytest.approx((1000 * 0.25 + 500 * 1.25) / 1e6)


def test_compiled_specs_replace_calls(records, tmp_path):
    spec = {"mappings": {"order_key": "$.orderKey", "ship_mode": "$.shipMode"}}

    def answer(request):
        if "Target JSON Schema" in request["user_prompt"]:
            return {"content": json.dumps(spec), "model": "m"}
        return rename(request)

    client = Logged(tmp_path / "log", answer)
    config = flow_config(reuse=ReuseOptions(spec_path=str(tmp_path / "specs"), merge_equal=False))
    flow = Pipeline(config, client)
    assert flow.transform(users(records, 4)).good.count() == 4
    flow.compile(users(records, 4))
    assert len(client.calls) == 2
    result = flow.transform(users(records, 8))
    assert {r["route"] for r in result.good.collect()} == {"compiled"} and result.good.count() == 8
    flow.compile(users(records, 8))
    assert len(client.calls) == 2


def test_lost_outputs_are_redone_one_by_one(records, tmp_path):
    def answer(request):
        batch = json.loads(request["user_prompt"].split("\n", 1)[1])
        if len(batch) > 1:
            batch = batch[:-1]
        out = [{"order_key": json.loads(b["value"])["orderKey"], "ship_mode": "e"} for b in batch]
        return {"content": json.dumps(out)} if "u5" not in json.dumps(out) else {"content": '[{"order_key":5}]'}

    client = Logged(tmp_path / "log", answer)
    result = Pipeline(flow_config(), client).transform(users(records, 6))
    assert sorted(r["key"] for r in result.good.collect()) == ["k0", "k1", "k2", "k3", "k4"]
    bad = result.quarantine.collect()
    assert [r["key"] for r in bad] == ["k5"] and bad[0]["error_message"] == "no valid output"


def test_parallel_calls(records, tmp_path):
    client = Logged(tmp_path / "log", rename)
    config = FlowConfig(contract=TARGET, batches=BatchOptions(size=6, parallel_calls=3), reuse=ReuseOptions(merge_equal=False))
    result = Pipeline(config, client).transform(users(records, 6))
    assert result.good.count() == 6 and len(client.calls) == 3


def test_similar_records_hit_the_cache(records, tmp_path):
    client = Logged(tmp_path / "log", rename)
    config = flow_config(reuse=ReuseOptions(cache_path=str(tmp_path / "cache"), similarity=0.9))
    words = " ".join(f"w{i}" for i in range(40))
    make = lambda tail: records({"orderKey": "u", "shipMode": "e", "text": words + tail})
    Pipeline(config, client, L.HashEmbedder()).transform(make("")).good.count()
    result = Pipeline(config, client, L.HashEmbedder()).transform(make(" extra"))
    assert [r["route"] for r in result.good.collect()] == ["cache"] and len(client.calls) == 1


def test_nulls_pass_and_bad_records_without_client_are_kept(records):
    config = FlowConfig(router=RouterOptions(enabled=True, patterns=("field_rename",)), batches=BatchOptions(size=1))
    result = Pipeline(config).transform(records({"aB": 1}, None, {"deep": {"x": {"y": 1}}}, "{bad"))
    assert sorted((r["key"], r["route"]) for r in result.good.collect()) == [("k0", "rules"), ("k1", "empty")]
    assert sorted(r["key"] for r in result.quarantine.collect()) == ["k2", "k3"]


def test_stream_equals_batch_and_replays_nothing(spark, records, tmp_path):
    source = str(tmp_path / "in")
    users(records, 12).repartition(3).write.parquet(source)
    client = Logged(tmp_path / "log", rename)
    flow = Pipeline(flow_config(), client)
    out = str(tmp_path / "out")
    stream = spark.readStream.schema("ordinal long, key string, value string").option("maxFilesPerTrigger", 1).parquet(source)
    sink = lambda result, batch_id: runner.write_once(result.good, out, batch_id)
    for _ in range(2):
        flow.start(stream, sink, str(tmp_path / "state")).awaitTermination()
    got = sorted((r["key"], r["value"]) for r in spark.read.parquet(out).collect())
    want = sorted((r["key"], r["value"]) for r in flow.transform(users(records, 12)).good.collect())
    assert got == want


def test_versioned_table_replay(spark, tmp_path):
    table = runner.VersionedTable(spark, str(tmp_path / "t"))
    assert table.current() is None
    table.publish(spark.range(3), 0)
    table.publish(spark.range(5), 1)
    os.makedirs(tmp_path / "t" / "version=2")  # never finished
    assert table.current().count() == 5 and table.before(1).count() == 3 and table.before(0) is None


# ------------------------------------------------------------------- crawl


def test_crawl_with_a_function(spark):
    def fetch(url):
        page = int(url.split("page=")[1])
        return {"status": 200, "body": json.dumps({"items": [{"p": page, "i": i} for i in range(2 if page < 4 else 0)]})}

    seeds = spark.sql("select 'http://h/x' url union all select 'http://h/y?q=1'")
    out = crawl(seeds, fetch_with(fetch), "page", "items")
    assert out.count() == 12 and {r["round"] for r in out.collect()} == {0, 1, 2}


def test_crawl_fails_on_errors(spark):
    with pytest.raises(RuntimeError, match="404 http://h/x"):
        crawl(spark.sql("select 'http://h/x' url"), fetch_with(lambda u: {"status": 404, "body": ""}))


# ------------------------------------------------------- numbers, envelope, gate


def drifting(request):
    """Leaves out the first, a middle or the last output, adds one, or repeats a number, by the first order of the batch."""
    batch = json.loads(request["user_prompt"].split("\n", 1)[1])
    out = [{"_n": b["_n"], "order_key": json.loads(b["value"])["orderKey"], "ship_mode": "e"} for b in batch]
    kind = int(out[0]["order_key"][1:]) % 7 if len(out) > 1 else 6
    if kind == 0:
        out = out[1:]
    elif kind == 1:
        out = out[:1] + out[2:]
    elif kind == 2:
        out = out[:-1]
    elif kind == 3:
        out.append({"_n": 99, "order_key": "surplus", "ship_mode": "e"})
    elif kind == 4:
        out = [{k: v for k, v in o.items() if k != "_n"} for o in out][1:]
    elif kind == 5:
        out[1]["_n"] = out[0]["_n"]
    return {"content": json.dumps(out)}


def test_outputs_stay_with_their_records(records, tmp_path):
    rows = records(*[{"orderKey": f"u{i // 4 if i % 4 == 0 else 100 + i}", "shipMode": "e"} for i in range(28)])
    rows = rows.withColumn("src_offset", F.create_map(F.lit("o"), F.col("ordinal").cast("string")))
    result = Pipeline(flow_config(), Logged(tmp_path / "log", drifting)).transform(rows)
    assert result.quarantine.count() == 0
    good = result.good.collect()
    own = {r["key"]: r for r in good if r["key"] is not None}
    sent = {r["key"]: json.loads(r["value"])["orderKey"] for r in rows.collect()}
    assert {k: json.loads(r["value"])["order_key"] for k, r in own.items()} == sent and len(good) == 29
    assert all(r["source"]["src_offset"] == {"o": str(r["source"]["ordinal"])} for r in own.values())
    (extra,) = [r for r in good if r["key"] is None]
    assert json.loads(extra["value"]) == {"order_key": "surplus", "ship_mode": "e"} and extra["source"] is None


def test_dead_letters_keep_their_source(records):
    rows = records({"deep": {"x": 1}}).withColumn("headers", F.create_map(F.lit("h"), F.lit("1")))
    (lost,) = Pipeline(FlowConfig()).transform(rows).quarantine.collect()
    assert lost["key"] == "k0" and lost["source"]["headers"] == {"h": "1"}


def test_calls_count_once(records, tmp_path):
    config = flow_config(reuse=ReuseOptions(call_log_path=str(tmp_path / "calls"), merge_equal=False))
    client = Logged(tmp_path / "log", rename)
    first = Pipeline(config, client).transform(users(records, 12))
    assert first.calls.count() == len(client.calls) == 3
    again = Pipeline(config, client).transform(users(records, 12))
    assert again.calls.count() == 0 and again.good.count() == 12 and len(client.calls) == 3


def test_slow_calls_end_and_order_stays(spark):
    import time as clock

    def answer(request):
        if request["user_prompt"] == "p3":
            clock.sleep(30)
        return {"content": json.dumps([request["user_prompt"], request.get("seed")])}

    client = type("C", (), {"call": staticmethod(answer)})()
    df = spark.range(0, 12, 1, 1).selectExpr("concat('p', id) user_prompt")
    began = clock.monotonic()
    rows = L.complete(df, client, time_limit=3.0, at_once=4, options={"seed": 5}).collect()
    assert clock.monotonic() - began < 25
    assert {r["user_prompt"]: r["call_error"] for r in rows if r["call_error"]} == {"p3": "no answer within 3 s"}
    assert all(json.loads(r["content"]) == [r["user_prompt"], 5] for r in rows if not r["call_error"])


def test_failed_embeddings_become_nulls(spark):
    class Fragile(L.HashEmbedder):
        def embed(self, texts):
            if any(t == "bad" for t in texts):
                raise RuntimeError("no")
            return super().embed(texts)

    rows = L.embed(spark.sql("select explode(array('a', 'bad', 'b', 'a', null)) text"), Fragile(4), wait_seconds=0.0).collect()
    assert sorted((str(r["text"]), r["embedding"] is not None) for r in rows) == [("None", False), ("a", True), ("a", True), ("b", True), ("bad", False)]


PATHS = ["$.items[0][1]", "$.items[0]x", "$.m.", "$.m", "m.n", "$", "", "$.", ".", "$.items[99999999999]", "$.items[2147483647]",
         "items[+0]", "[0]", "$.items[01].k", "$.a b", "$.it's", '$.q"', "$.x..y", "$.items[-1]", "$.items[", "$.items[0]..", "$.q\"'"]


@pytest.mark.parametrize("count", [1, 64, 65, 500])
def test_specs_resolve_alike_at_any_number(spark, records, count):
    value = {"items": [{"k": 1}, 2], "m": {"n": None, "": 3}, "a b": 4, "it's": 5, 'q"': 6, "$": 7, "": {"": 8}, "q\"'": 9, "x": {"": {"y": 1}}}
    spec = {"mappings": {f"o{i}": p for i, p in enumerate(PATHS)} | {"n": 5}, "defaults": {"d": [1], "o1": "none"}, "typeCasts": {"o3": "string"}}
    specs = spark.createDataFrame([("f0", U.DECLARATIVE, json.dumps(spec))] + [(f"f{i}", U.DECLARATIVE, '{"mappings":{"a":"b"}}') for i in range(1, count)], "fingerprint string, type string, code string")
    rows = records(value, [1]).withColumn("fingerprint", F.lit("f0"))
    out = [json.loads(r["output"]) for r in U._with_output(rows, specs, "value").orderBy("ordinal").collect()]
    expected = [json.loads(r["v"]) for r in rows.select("ordinal", U.mapped(V.parse(F.col("value")), spec).alias("v")).orderBy("ordinal").collect()]
    assert out == expected and "o9" not in out[0] and out[0]["o1"] is not None


def test_an_id_stored_twice_hits_once(spark):
    cache = spark.sql("""select 1 cache_id, array(1f, 0f) embedding, 'old' output, timestamp'2024-01-01' created_at
                         union all select 1, array(1f, 0f), 'new', timestamp'2024-01-02'""")
    found = U.cache_lookup(spark.sql("select 7 query_id, array(1f, 0f) embedding"), cache).collect()
    assert [(r["query_id"], r["output"]) for r in found] == [(7, "new")]


@pytest.mark.parametrize(
    "expression",
    ["`reflect`('java.lang.System', 'exit', '1')", "reflect ('a','b')", "upper(`java_method`('a','b'))", "system.builtin.reflect('a','b')",
     "\"'\" || reflect('a', 'b') || \"'\"", "transform(array(1), x -> assert_true(false))", "(select 1)", "r'\\' || reflect('a') || '\\'", "1;", "concat("],
)
def test_forbidden_expressions(spark, expression):
    from recordflow.operators.mapping import check_expression

    with pytest.raises(ValueError):
        check_expression(expression)


def test_crawl_fails_where_pages_are_left(spark):
    fetch = fetch_with(lambda u: {"status": 200, "body": '{"items":[{"a":1}]}'})
    with pytest.raises(RuntimeError, match="pages are left after 2 rounds"):
        crawl(spark.sql("select 'http://h/x' url"), fetch, "page", "items", max_rounds=2)


def test_ranges_grow_beyond_the_shuffle_setting(spark, monkeypatch):
    from recordflow.operators import staging

    monkeypatch.setattr(staging, "source_bytes", lambda df: (10 << 40, True))
    assert staging.spread_count(spark.range(3)) > 100_000 > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_entries_at_the_mark_once(spark):
    from recordflow.operators.records import entries_since

    rows = [("d1", "mail", "a", 5), ("d1", "mail", "b", 5), ("d1", "cn", "c", 5), ("d1", "mail", "a", 5)]
    df = spark.createDataFrame(rows, "dn string, attribute string, value string, m int")
    assert entries_since(df, "m", None).count() == 4 and entries_since(df, "m", 5).count() == 3 and entries_since(df, "m", 4).count() == 4


def test_visits_of_a_low_threshold_are_made_in_slices():
    """Nearly all cells are visited by every query: no frame holds more than a slice, and none is lost."""
    rng = np.random.default_rng(1)
    pivots = rng.normal(size=(600, 64)).astype(np.float32)
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
    asked = rng.normal(size=(2000, 64)).astype(np.float32)
    asked /= np.linalg.norm(asked, axis=1, keepdims=True)
    frame = pd.DataFrame({"vec_key": [f"{i:032d}" for i in range(2000)], "vec": [v.tobytes() for v in asked]})
    sizes, seen = [], set()
    for part in U._visits(frame, pivots, np.full(600, 1.3), 0.9):
        sizes.append(len(part) * (64 * 4 + 32 + 4))
        seen.update(zip(part["query_key"], part["cell"]))
    gaps = U._distances(asked, pivots)
    wanted = np.argwhere((gaps <= 2.2) & (gaps - gaps.min(axis=1, keepdims=True) <= 1.8))
    assert seen == {(f"{q:032d}", c) for q, c in wanted} and len(seen) > 1_000_000
    assert max(sizes) <= U._SLICE_BYTES
