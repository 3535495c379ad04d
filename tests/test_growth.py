"""What keeps time in step with the input: no task for all records of a structure, no text searched again from each of its letters."""

import json
import threading
import time

from pyspark.sql import functions as F

from recordflow.functions import variant as V
from recordflow.operators import mapping as M
from recordflow.operators import model as L
from recordflow.operators import privacy as P
from recordflow.operators import reuse as U
from recordflow.operators.contract import Contract


def test_records_of_a_structure_stay_spread(spark):
    records = spark.range(0, 4000, 1, 8).selectExpr("id", "concat('same', id div 4000) fingerprint", """concat('{"n":', id, '}') value""")
    code = """'{"mappings":{"m":"$.n"},"typeCasts":{"m":"string"}}'"""
    specs = spark.sql(f"select 'same0' fingerprint, 'DECLARATIVE' type, {code} code, current_timestamp() created_at, 'x' model")
    # Large records are not broadcast, and how few structures fail Spark learns only after it has shuffled both.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, rest, invalid = U.apply_compiled(records, specs, Contract.parse({"properties": {"m": {"type": "integer"}}}))
        assert [tuple(r) for r in invalid.collect()] == [("same0", 4000)]
        assert rest.count() == 4000
        assert rest.select(F.spark_partition_id()).distinct().count() == 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_without_specs_all_is_left(spark):
    records = spark.sql("""select 'f' fingerprint, v value from values ('{"a":1}'), ('{bad'), (null) as t(v)""")
    none = spark.createDataFrame([], U.SPEC_COLUMNS)
    done, rest, invalid = U.apply_compiled(records, none, Contract())
    assert [r.value for r in done.collect()] == [None]
    assert sorted(r.value for r in rest.collect()) == ['{"a":1}', "{bad"]
    assert invalid.count() == 0


def test_words_are_not_searched_from_each_letter(spark):
    assert P._searched("[a-z0-9]+@x") == "[a-z0-9]@x"
    assert P._searched("[^@ ]+?x") == "[^@ ]x"
    for kept in ("[a-z]++@", "(?i)[a-z]+@", "a[b]+", "[a&&[b]]+c", r"[\d]+x", "[a-z]{2,}x", "[]a]+b", "[a-z]+{2}"):
        assert P._searched(kept) == kept
    texts = ["ab1@x", "@x", "AB@x", "a @x", "", "x@xa", "ab\n9@x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for p in ("[a-z0-9]+@x", "[^a]+@x", "[a-z]+|@", "[a-z0-9]+?@x$"):
        same = df.filter(F.col("t").rlike(p) != F.col("t").rlike(P._searched(p)))
        assert same.isEmpty()


def test_calls_share_threads():
    names = set()

    def answer(row):
        names.add(threading.get_ident())
        time.sleep(0.001)
        return row["request_hash"]

    started, real = [], threading.Thread.start
    threading.Thread.start = lambda self: (started.append(self), real(self))[1]
    try:
        found = L._in_pool([{"request_hash": i} for i in range(200)], answer, 4, None)
    finally:
        threading.Thread.start = real
    assert found == list(range(200))
    assert len(started) == 4


def test_a_thread_left_behind_is_replaced():
    def answer(row):
        time.sleep(1.5 if row["request_hash"] < 2 else 0.01)
        return {"call_error": None}

    found = L._in_pool([{"request_hash": i} for i in range(30)], answer, 2, 0.3)
    assert [r["call_error"] for r in found] == ["no answer within 0.3 s"] * 2 + [None] * 28


CAST_SPEC = {"mappings": {t: "$.x" for t in ("integer", "number", "boolean", "string", "kept")}, "defaults": {"none": None}}
CAST_SPEC["typeCasts"] = {t: t for t in CAST_SPEC["mappings"]}


def test_casts_read_each_value_once(records):
    plan = M.apply_mapping(records({"x": 1}), CAST_SPEC)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan
    assert plan.count(", StringType, ") <= 4 and plan.count("schemaOfVariant") == 4


def test_casts_by_steps_give_what_single_casts_give(records):
    texts = """"12" "+7" " 12" "12\\n" "1e3" ".5d" "1e999" "NaN" "TRUE" "tRuE" "true " "" "q\\"\\\\\\u00e9\\u0001\\/\u00e9" 12 -0 0.5 -0.0 1.0 10.10 -9.99
        1e3 1e-7 1e30 1e999 123456789012345678 -1234567890123456789 12345678901234567890 123456789012345678901234567890
        100000000000000000000000000000000000000 123456789012345678901234567890123456789 1234567890.123456789 true false null
        {} [] {"a":[1,"2"]} [1.5,null]""".split()
    rows = records(*[f'{{"x":{t}}}' for t in texts], "{}", "{bad", "[1]", "7", None, '{"y":1}', '{"x": "a b"}')
    want = rows.select("ordinal", M.mapped(V.parse(F.col("value")), CAST_SPEC).alias("value"))
    found = M.apply_mapping(rows, CAST_SPEC).select("ordinal", "value")
    assert [tuple(r) for r in found.orderBy("ordinal").collect()] == [tuple(r) for r in want.orderBy("ordinal").collect()]


def test_places_of_placeholders_are_not_searched_per_token(records):
    rows = records({"note": "u@x", "a": ["b@x", "c", "d@x"], "k\"@x": {"NOTE": "", "z": "e@x"}}, '{"note" : "f"}', ["g@x"], '"h@x"', {"a": 1}, None)
    out = P.mask(rows, ["note", 'k"@x'], ["@x"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains" not in plan and "array_position" not in plan
    marks = lambda *at: [f"[MASKED_{i}]" for i in at]
    want = [
        json.dumps({"note": marks(0)[0], "a": [marks(1)[0], "c", marks(2)[0]], "k\"@x": {"NOTE": marks(3)[0], "z": marks(4)[0]}}),
        '{"note" : "[MASKED_0]"}', json.dumps(marks(0)), '"[MASKED_0]"', '{"a": 1}', None,
    ]
    found = out.orderBy("ordinal").collect()
    assert [r.value for r in found] == want
    assert found[0].mask_map == dict(zip(marks(0, 1, 2, 3, 4), ["u@x", "b@x", "d@x", "", "e@x"]))
    assert [r.value for r in P.unmask(out).orderBy("ordinal").collect()] == [r.value for r in rows.orderBy("ordinal").collect()]


def test_numbers_of_answers_are_read_once(spark):
    content = ['[{"_n":1,"a":1},{"_n":0,"a":2}]', '[{"a":1},{"a":2}]', '[{"_n":0,"a":1},{"a":2}]', '[{"_n":0},{"_n":0}]', '[{"_n":0},{"_n":7}]', "no", "[1,2]"]
    answers = spark.createDataFrame([(i, 2, c) for i, c in enumerate(content)], "batch_id long, records int, content string")
    out = L.numbered_results(answers, ["batch_id"])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("$._n") == 1
    found = {}
    for r in out.collect():
        found.setdefault(r.batch_id, set()).add((r.ordinal, r.value))
    assert found == {
        0: {(1, '{"a":1}'), (0, '{"a":2}')},
        1: {(0, '{"a":1}'), (1, '{"a":2}')},
        4: {(0, "{}"), (None, "{}")},
        6: {(0, "1"), (1, "2")},
    }


def test_depths_by_levels_are_depths_by_brackets(spark):
    def walked(text):
        at = top = 0
        for ch in text:
            at += 1 if ch in "{[" else -1
            top = max(top, at)
        return top

    texts = ["", "{}", "[]", "{[]}", "{}{}", "{{}{}}", "[{}[[]]]", "{{{{}}}}", "[[[[[]]]]]", "{" * 9 + "}" * 9, "{}{{", "}{", "{}}}", "[}", "{}{[{]}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(V.bracket_depth(F.col("t"))).collect()] == [walked(t) for t in texts]
