import json

import pytest
from pyspark.sql import functions as F

from recordflow.functions import text as T
from recordflow.functions import variant as V
from recordflow.operators import mapping as M


def one(spec, value, records, read):
    return read(M.apply_mapping(records(value), spec))[0]


@pytest.mark.parametrize(
    "spec, value, expected",
    [
        (
            {"mappings": {"key": "$.o_orderkey", "status": "o_orderstatus", "lines": "$.lines"}},
            {"o_orderkey": 7, "o_orderstatus": "F", "lines": [1, 2], "o_comment": "unused"},
            {"key": 7, "status": "F", "lines": [1, 2]},
        ),
        (
            {"mappings": {"nation": "$.ship.to.nation", "whole": "$.ship.to", "gone": "$.ship.to.nation.code"}},
            {"ship": {"to": {"nation": "PERU"}}},
            {"nation": "PERU", "whole": {"nation": "PERU"}},
        ),
        (
            {"mappings": {"last": "$.lines[1].part", "tax": "lines[0].tax", "none": "$.lines[2].part", "deep": "$.grid[1]"}},
            {"lines": [{"tax": 0.5}, {"part": "bolt"}], "grid": [[1], [2, 3]]},
            {"last": "bolt", "tax": 0.5, "deep": [2, 3]},
        ),
        (
            {"mappings": {"price": "$.price"}, "defaults": {"price": 0, "tags": ["new"], "by": None}},
            {"price": None},
            {"price": None, "tags": ["new"], "by": None},
        ),
        (
            {
                "mappings": {n: n for n in ("quantity", "discount", "returned", "line", "shipped")},
                "typeCasts": {"quantity": "integer", "discount": "number", "returned": "boolean", "line": "string", "shipped": "boolean"},
            },
            {"quantity": 17.9, "discount": "4e-2", "returned": "TRUE", "line": 3, "shipped": 0},
            {"quantity": 17, "discount": 0.04, "returned": True, "line": "3", "shipped": False},
        ),
        ({"mappings": {"a": "$.o.p.q", "b": "$.o.p"}}, {"o": {"p": 5}}, {"b": 5}),
        ({"mappings": {"a": "$.a", "b": "$.a.b"}}, {"a": None}, {"a": None}),
        ({"mappings": {"a": "$.a b", "c": "$.q\"q", "d": "x'y"}}, {"a b": 1, 'q"q': 2, "x'y": 3}, {"a": 1, "c": 2, "d": 3}),
        ({"mappings": {"root": "$[0]", "neg": "$.a[-1]", "bad": "$.a[x]"}}, {"a": [1]}, {}),
        ({"mappings": {}}, {"a": 1}, {}),
        ({"mappings": {"n": "$.n"}, "defaults": {"n": 5}}, {"n": None}, {"n": None}),
    ],
)
def test_mapping_cases(spec, value, expected, records, read):
    assert one(spec, value, records, read) == expected


@pytest.mark.parametrize(
    "target, value, expected",
    [
        ("integer", "12", 12),
        ("integer", "+12", 12),
        ("integer", " 12", " 12"),
        ("integer", "1.5", "1.5"),
        ("integer", 9.99, 9),
        ("integer", -9.99, -9),
        ("integer", True, True),
        ("number", "1e3", 1000.0),
        ("number", "x", "x"),
        ("number", 5, 5),
        ("boolean", "TRUE", True),
        ("boolean", "yes", False),
        ("boolean", 0, False),
        ("boolean", 0.5, False),
        ("boolean", -2, True),
        ("string", True, "true"),
        ("string", {"a": 1}, ""),
        ("string", [1], ""),
        ("string", None, None),
        ("unknown", 5, 5),
    ],
)
def test_casts(target, value, expected, records, read):
    spec = {"mappings": {"x": "$.x"}, "typeCasts": {"x": target}}
    got = one(spec, {"x": value}, records, read)["x"]
    assert got == expected and type(got) is type(expected)


def test_bad_json_maps_to_null(records, read):
    out = M.apply_mapping(records("{bad", None, '{"a":1,"a":2}', {"a": 1}), {"mappings": {"b": "$.a"}})
    assert read(out) == [None, None, None, {"b": 1}]


def test_spec_check():
    assert M.is_mapping_spec('{"mappings":{}}')
    assert not M.is_mapping_spec('{"mappings":[]}')
    assert not M.is_mapping_spec("NEEDS_SQL")


def test_names(spark):
    names = ["firstName", "lastName", "already_snake", "aBC", "simple", "userID2X"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(T.camel_to_snake(F.col("n")))
    assert [r[0] for r in df.collect()] == ["first_name", "last_name", "already_snake", "a_bc", "simple", "user_id2x"]


def test_sql_transform(records, read):
    value = {"firstName": "A", "lastName": "B", "active": True, "age": "30", "products": [{"productName": "p1"}, {"productName": "p2"}]}
    out = M.apply_sql_transform(
        records(value, {"firstName": None}),
        {
            "name": "concat_ws(' ', try_variant_get(input, '$.firstName', 'string'), try_variant_get(input, '$.lastName', 'string'))",
            "status": "case when try_variant_get(input, '$.active', 'boolean') then 'on' else 'off' end",
            "age": "try_cast(try_variant_get(input, '$.age', 'string') as int)",
            "first": "coalesce(try_variant_get(input, '$.firstName', 'string'), 'unknown')",
            "labels": "transform(try_variant_get(input, '$.products', 'array<variant>'), p -> upper(try_variant_get(p, '$.productName', 'string')))",
        },
    )
    assert read(out) == [
        {"name": "A B", "status": "on", "age": 30, "first": "A", "labels": ["P1", "P2"]},
        {"name": "", "status": "off", "first": "unknown"},
    ]


@pytest.mark.parametrize("text", ["rand()", "java_method('x','y')", "(select 1)", "1; drop table x", "reflect('a')", "current_timestamp()"])
def test_sql_transform_rejects(text):
    with pytest.raises(ValueError):
        M.check_expression(text)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("```json\n[1]\n```", "[1]"),
        ("```\n{}\n```  ", "{}"),
        ("  [1] ", "[1]"),
        ("```[1]```", "```[1]"),
        (None, ""),
    ],
)
def test_fences(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(V.strip_fences(F.col("t")))
    assert df.first()[0] == expected


def test_first_array(records):
    rows = records([1, 2], '{"a":1,"z":[3],"b":[4]}', {"a": 1}, "bad")
    got = [r[0] for r in rows.orderBy("ordinal").select(V.first_json_array(F.col("value"))).collect()]
    assert got == ["[1,2]", "[3]", None, None]


def test_url_template(records):
    rows = records({"id": 5, "name": "x"}, "{bad", {"id": None})
    got = [r[0] for r in rows.orderBy("ordinal").select(T.render_url("/u/{id}/{name}", F.col("value"))).collect()]
    assert got == ["/u/5/x", "/u/{id}/{name}", "/u/null/name"]


def test_long_literals_do_not_overflow(records):
    big = json.dumps({"a": 'x"\\{:' * 200_000, "b": {"c": [1]}})
    row = records(big).select(V.field_count(F.col("value")), V.json_depth(F.col("value"))).first()
    assert tuple(row) == (3, 3)
