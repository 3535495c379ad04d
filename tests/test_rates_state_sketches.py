import json
import time
import uuid
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recordflow.operators import accounting as A
from recordflow.operators import merge as M
from recordflow.operators import reuse as U
from recordflow.operators.contract import Contract
from recordflow.operators.model import CallFailed, complete
from recordflow.operators.pace import Pace, PacedClient
from recordflow.operators.profiling import with_fingerprint
from recordflow.operators.records import continue_replay_ids
from recordflow.sources.crawl import fetch_with
from recordflow.streaming.specs import SpecTable

# ------------------------------------------------------------------ one rate


class Clock:
    def __init__(self, now=1000.03):
        self.now = now

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.now += seconds


def test_tasks_never_share_a_slot():
    starts = []
    for task in range(3):
        clock = Clock()
        pace = Pace(7.0, 3, task, clock, clock.sleep)
        for _ in range(20):
            pace.wait()
            starts.append(round(clock.now * 7))
    assert len(set(starts)) == len(starts) and max(starts) - min(starts) <= len(starts) + 3


def test_a_wait_asked_for_holds_all_calls_of_a_task():
    clock = Clock()
    pace = Pace(10.0, 1, 0, clock, clock.sleep)
    seen = []

    class Busy:
        def call(self, request):
            seen.append(clock.now)
            if len(seen) == 1:
                raise CallFailed(429, "busy", retry_after=30.0)
            return {}

    client = PacedClient(Busy(), pace)
    with pytest.raises(CallFailed):
        client.call({})
    client.call({})
    assert seen[1] - seen[0] >= 30.0


def test_no_rate_no_wait():
    clock = Clock()
    Pace(None, clock=clock, sleep=clock.sleep).wait()
    assert clock.now == 1000.03


def timed_client(folder):
    class Timed:
        def call(self, request):
            (Path(folder) / uuid.uuid4().hex).write_text(repr(time.time()))
            return {"content": "{}"}

    return Timed()


@pytest.mark.parametrize("partitions", [1, 6])
def test_no_second_of_a_job_exceeds_the_rate(spark, tmp_path, partitions):
    requests = spark.range(45).selectExpr("concat('p', id) user_prompt").repartition(partitions)
    assert complete(requests, timed_client(str(tmp_path)), want_array=False, calls_per_second=15.0).count() == 45
    at = sorted(float(f.read_text()) for f in tmp_path.iterdir())
    assert len(at) == 45
    # One more call may fall into a window when a thread starts a little late.
    assert max(sum(a <= b < a + 1 for b in at) for a in at) <= 16


def test_a_host_that_asks_for_a_wait_gets_it(spark, tmp_path):
    folder = str(tmp_path)

    def page(url):
        mark = Path(folder) / uuid.uuid4().hex
        mark.write_text(json.dumps([url, time.time()]))
        busy = url == "http://a/0" and sum(json.loads(f.read_text())[0] == url for f in Path(folder).iterdir()) == 1
        return {"status": 429, "retry_after": 1.0} if busy else {"status": 200, "body": url}

    urls = [f"http://{h}/{i}" for h in "ab" for i in range(3)]
    frontier = spark.createDataFrame([(u, u) for u in urls], "seed string, url string").coalesce(1)
    got = fetch_with(page, per_host=20.0, retries=2)(frontier).collect()
    assert sorted((r.url, r.status, r.body) for r in got) == [(u, 200, u) for u in urls]
    seen = sorted((at, url) for url, at in (json.loads(f.read_text()) for f in tmp_path.iterdir()))
    of_a = [at for at, url in seen if url.startswith("http://a")]
    first = next(i for i, (_, url) in enumerate(seen) if url == "http://a/0")
    again = [at for at in of_a if at > seen[first][0]]
    assert again and min(again) - seen[first][0] >= 0.99
    for host in "ab":
        at = [x for x, url in seen if url.startswith(f"http://{host}")]
        assert all(b - a >= 0.045 for a, b in zip(at, at[1:]))


def test_a_status_that_stays_is_returned(spark):
    frontier = spark.createDataFrame([("s", "http://a/1")], "seed string, url string")
    got = fetch_with(lambda url: {"status": 503, "retry_after": 0.01}, retries=2)(frontier).collect()
    assert [(r.url, r.status, r.body) for r in got] == [("http://a/1", 503, None)]


# ---------------------------------------------------------------- replay ids


def _plain_ids(batches):
    last, out = {}, {}
    for rows in batches:
        for channel, at, given in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
            last[channel] = given if given is not None else last.get(channel, 0) + 1
            out[channel, at] = last[channel]
    return out


def test_replay_ids_go_on_between_batches(spark):
    batches = [
        [("a", 1, None), ("a", 2, 70), ("b", 3, None), (None, 4, None), ("a", 5, None)],
        [("a", 6, None), (None, 7, 3), (None, 8, None), ("c", 9, None), ("", 10, None)],
        [("b", 11, None), ("a", 12, 5), ("a", 13, None), ("", 14, None)],
    ]
    known, found = None, {}
    for rows in batches:
        values = [(c, at, json.dumps({"event": {"replayId": g}} if g is not None else {"event": {}})) for c, at, g in rows]
        df = spark.createDataFrame(values, "channel string, at long, value string")
        numbered, known = continue_replay_ids(df, known, ["channel"], ["at"])
        assert numbered.columns == ["channel", "at", "value", "replay_id"]
        found |= {(r.channel, r.at): r.replay_id for r in numbered.collect()}
    assert found == _plain_ids(batches)
    _, same = continue_replay_ids(spark.createDataFrame([], "channel string, at long, value string"), known, ["channel"], ["at"])
    assert sorted(map(str, same.collect())) == sorted(map(str, known.collect()))


# ------------------------------------------------------------------- upserts


def test_upsert_of_some_columns_is_one_join(spark):
    target = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0), (2, "z", None), (None, "n", 4.0)], "k int, a string, b double")
    changes = spark.createDataFrame(
        [(1, 9, 0), (2, None, 0), (2, 7, 1), (3, 5, 0), (None, 6, 0)], "k int, b int, at int"
    )
    out = M.merge_upsert(target, changes, ["k"], "at")
    want = [(1, "x", 9.0), (1, "y", 9.0), (2, "z", 7.0), (3, None, 5.0), (None, None, 6.0), (None, "n", 4.0)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "string", "double"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    empty = M.merge_upsert(target.limit(0), changes, ["k"], "at")
    assert empty.count() == 4 and M.merge_upsert(target, changes.limit(0), ["k"], "at").count() == 4


# ------------------------------------------------------------------ sketches


def test_sketches_of_days_merge_to_those_of_all(spark):
    rows = [("a", d, float(v) if v % 5 else None, f"u{v % 7}") for d in range(3) for v in range(d * 10, d * 10 + 20)]
    rows += [("empty", 0, None, None), (None, 1, 2.0, "x")]
    log = spark.createDataFrame(rows, "kind string, day int, ms double, user string")
    stored = A.usage_sketches(log, ["kind", "day"], ["ms"], ["user"])
    found = {r.kind: r for r in A.read_sketches(A.merge_sketches(stored, ["kind"]), (0.5, 0.99)).collect()}
    once = {r.kind: r for r in A.read_sketches(A.usage_sketches(log, ["kind"], ["ms"], ["user"]), (0.5, 0.99)).collect()}
    assert found == once
    values = sorted(r[2] for r in rows if r[0] == "a" and r[2] is not None)
    nearest = lambda q: values[-(-int(q * 100) * len(values) // 100) - 1]
    a = found["a"]
    assert (a.records, a.ms_p50, a.ms_p99, a.user_distinct) == (60, nearest(0.5), nearest(0.99), 7)
    assert (found["empty"].records, found["empty"].ms_p50, found["empty"].user_distinct) == (1, None, 0)
    assert (found[None].ms_p50, found[None].user_distinct) == (2.0, 1)
    assert A.read_sketches(A.usage_sketches(log.limit(0), ["kind"], ["ms"], ["user"])).collect() == []


# --------------------------------------------------------- many SQL specs, spec table


def test_sql_specs_in_groups_give_what_one_plan_gives(spark, monkeypatch):
    values = [None, "not json"] + [json.dumps({f"f{i % 5}": i}) for i in range(40)]
    df = spark.createDataFrame(list(enumerate(values)), "n int, value string")
    marked = with_fingerprint(df, "", "flat")
    of = {json.loads(r.value).popitem()[0]: r.fingerprint for r in marked.collect() if r.value and r.value[0] == "{"}
    sql = lambda f: json.dumps({"out": f"try_variant_get(input, '$.{f}', 'bigint') * 2"})
    specs = [(of[f], "SQL_EXPR", sql(f)) for f in ("f0", "f1", "f2")] + [(of["f3"], "DECLARATIVE", '{"mappings": {"out": "$.f3"}}')]
    specs = spark.createDataFrame(specs, "fingerprint string, type string, code string")
    whole = sorted(map(str, U._with_output(marked, specs, "value").collect()))
    monkeypatch.setattr(U, "SQL_GROUP", 2)
    assert sorted(map(str, U._with_output(marked, specs, "value").collect())) == whole
    assert sum("output='{" in r for r in whole) == 32 and len(whole) == 42


def test_proposals_are_read_in_groups(spark, monkeypatch):
    monkeypatch.setattr(U, "SQL_GROUP", 2)
    good = json.dumps({"out": "try_variant_get(input, '$.f', 'bigint')"})
    proposed = [("a", "SQL_EXPR", good), ("b", "SQL_EXPR", '{"out": "no_such(1)"}'), ("c", "SQL_EXPR", "[]"), ("d", "SQL_EXPR", good)]
    proposed += [("e", "DECLARATIVE", '{"mappings": {"out": "$.f"}}'), ("f", "DECLARATIVE", "no"), ("g", "SQL_EXPR", None), ("h", "SQL_EXPR", good)]
    samples = [(p[0], '{"f": 3}' if p[0] != "h" else '{"f": "x"}') for p in proposed]
    accepted = U._accepted(
        spark.createDataFrame(proposed, "fingerprint string, type string, code string"),
        spark.createDataFrame(samples, "fingerprint string, value string"),
        Contract.parse({"properties": {"out": {"type": "integer"}}, "required": ["out"]}),
        "value",
    )
    assert sorted(r.fingerprint for r in accepted.collect()) == ["a", "d", "e"]


def test_spec_table_runs_a_batch_again_to_the_same_state(spark, tmp_path):
    class OutClient:
        def call(self, request):
            return {"content": '{"mappings": {"out": "$.f"}}'}

    table, contract = SpecTable(spark, str(tmp_path / "specs")), Contract.parse({"properties": {"out": {"type": "integer"}}})
    start = datetime(2024, 1, 1)

    def step(batch, values):
        df = spark.createDataFrame(list(enumerate(values)), "n int, value string")
        now = F.lit(start + timedelta(days=batch)).cast("timestamp")
        done, rest = table.step(
            with_fingerprint(df, contract.text, "flat"), batch, OutClient(), contract, "n", 86400 * 2, now, wait_seconds=0.0
        )
        return sorted(str(r.value) for r in done.collect()), sorted(r.value for r in rest.collect())

    assert step(0, ['{"f": 1}', None]) == (["None", '{"out":1}'], [])
    for _ in range(2):
        assert step(1, ['{"f": 2}', '{"f": 3}']) == (['{"out":2}', '{"out":3}'], [])
    assert step(2, []) == ([], [])
    assert step(3, ['{"f": 4}']) == (['{"out":4}'], [])
    assert sorted(r.batch for r in table.compiled().collect()) == [0, 3]
