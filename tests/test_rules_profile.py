import json

import pytest
from pyspark.sql import functions as F

from recordflow.functions import variant as V
from recordflow.operators import profiling as P
from recordflow.operators import rules as R


def test_rename(records, read):
    out = R.apply_patterns(
        records({"firstName": "a", "lastName": "b"}, {"first_name": 1, "firstName": 2}, {"firstName": 2, "first_name": 1}, {"fooBar": 1, "foo_Bar": 2}),
        ["field_rename"],
    )
    assert read(out) == [{"first_name": "a", "last_name": "b"}, {"first_name": 2}, {"first_name": 2}, {"foo_bar": 2}]
    assert [r["handled"] for r in out.collect()] == [True] * 4


def test_types(records, read):
    out = R.apply_patterns(
        records({"count": "42", "price": "9.99", "active": "true", "v": "1.2.3", "t": "x", "n": None, "o": {"a": "1"}, "big": "99999999999999999999"}),
        ["type_cast"],
    )
    assert read(out) == [
        {"count": 42, "price": 9.99, "active": True, "v": "1.2.3", "t": "x", "n": None, "o": {"a": "1"}, "big": "99999999999999999999"}
    ]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-15T10:30:00Z", "2024-01-15T10:30:00Z"),
        ("2024-01-15T10:30:00.500Z", "2024-01-15T10:30:00.500Z"),
        ("2024-01-15T10:30:00.5Z", "2024-01-15T10:30:00.500Z"),
        ("2024-01-15T10:30:00.123456789Z", "2024-01-15T10:30:00.123456789Z"),
        ("2024-01-15T10:30:00.1234Z", "2024-01-15T10:30:00.123400Z"),
        ("2024-01-15T10:30:00+02:00", "2024-01-15T08:30:00Z"),
        ("2024-02-30T10:30:00Z", "2024-02-30T10:30:00Z"),
        ("2024-01-15", "2024-01-15"),
        ("123456789", "123456789"),
        ("1705314600", "2024-01-15T10:30:00Z"),
        ("1705314600123", "2024-01-15T10:30:00.123Z"),
        ("1705314600000", "2024-01-15T10:30:00Z"),
        ("12345678901", "2361-03-21T19:15:01Z"),
        ("12345678901234", "12345678901234"),
    ],
)
def test_timestamps(records, read, text, expected):
    out = R.apply_patterns(records({"at": text}), ["timestamp_format"])
    assert read(out) == [{"at": expected}]


def test_order_of_patterns(records, read):
    rows = records({"at": "1705314600"})
    assert read(R.apply_patterns(rows, ["type_cast", "timestamp_format"])) == [{"at": 1705314600}]
    assert read(R.apply_patterns(rows, ["timestamp_format", "type_cast"])) == [{"at": "2024-01-15T10:30:00Z"}]


def test_handled(records):
    rows = records({"already_snake": 1}, [1], None, "{bad", {"aB": 1}, {})
    out = R.apply_patterns(rows, ["field_rename", "nonsense"]).orderBy("ordinal").collect()
    assert [r["handled"] for r in out] == [False, False, True, False, True, False]
    assert out[3]["value"] == "{bad"
    none = R.apply_patterns(rows, []).orderBy("ordinal").collect()
    assert not any(r["handled"] for r in none)


def test_batch_semantics(records):
    rows = records({"aB": 1}, {"b": 1}, {"aB": 1}).withColumn("batch_id", F.expr("ordinal div 2"))
    out = R.apply_patterns(rows, batch_semantics=True).orderBy("ordinal").collect()
    assert [r["handled"] for r in out] == [False, False, True]


TIERS = [
    ([{"a": 1, "b": 2}], ("field_rename",), 0),
    ([{"a": 1, "b": 2}], (), 1),
    ([{"user": {"address": {"city": 1}}}], (), 2),
    ([{**{f"f{i}": i for i in range(21)}, "a": {"b": {"c": {"d": 1}}}}], (), 3),
    (["{bad"], (), 3),
    ([None], (), 1),
    ([{f"f{i}": i for i in range(6)}], (), 2),
    ([{f"f{i}": i for i in range(6)}, None], (), 1),
    ([""], (), 1),
]


@pytest.mark.parametrize("values, patterns, tier", TIERS)
def test_tiers(records, values, patterns, tier):
    rows = records(*values).withColumn("batch_id", F.lit(1))
    out = P.route(rows, {1: "s", 2: "m", 3: "l"}, patterns)
    assert {r["tier"] for r in out.collect()} == {tier}
    single = P.route(rows.limit(1), {1: "s"}, patterns, granularity="record") if len(values) == 1 else None
    if single is not None:
        assert single.first()["tier"] == tier


def structure_cases():
    return [
        {"name": "x", "age": 30, "score": 9.5, "active": True, "data": None},
        {"a": {"b": {"c": 1}}, "z": []},
        {"items": [{"id": 1}, {"id": "x", "more": 1}]},
        [1, "a"],
        {},
        "text",
    ]


def test_structure(records):
    values = [v if not isinstance(v, str) else json.dumps(v) for v in structure_cases()]
    got = [r[0] for r in records(*values).orderBy("ordinal").select(V.exact_structure(F.col("value"))).collect()]
    assert got == [
        "{active=boolean, age=integer, data=null, name=string, score=number}",
        "{a=object, a.b=object, a.b.c=integer, z=array}",
        "{items=array, items[]=object, items[].id=integer}",
        "{_root=array, _root[]=integer}",
        "{}",
        "{=string}",
    ]


@pytest.mark.parametrize("mode", ["flat", "deep", "exact"])
def test_fingerprints(records, mode):
    rows = records({"a": 1, "b": "x"}, {"b": "y", "a": 2}, {"a": "1", "b": "x"}, {"a": 1.5, "b": "x"}, {"a": 10.25, "b": "q"}, {"a": 1.0, "b": "x"}, "{bad", "also bad")
    got = [r[0] for r in rows.orderBy("ordinal").select(V.fingerprint(F.col("value"), "t", mode)).collect()]
    assert got[0] == got[1] and len(got[0]) == 64
    assert got[0] != got[2] and got[0] != got[3]
    assert got[3] == got[4] == got[5]
    assert got[6] == got[7]
    other = rows.orderBy("ordinal").select(V.fingerprint(F.col("value"), "u", mode)).first()[0]
    assert other != got[0]


def test_flat_equals_exact(records):
    rows = records({"b": 1, "a": "x", "ab": 2.5}, {"n": None, "t": True})
    pairs = rows.select(V.flat_structure(F.col("value")), V.exact_structure(F.col("value"))).collect()
    assert all(a == b for a, b in pairs)


def test_structures_are_found_once_per_skeleton(records):
    """Values of any kind leave one short text, so that the tokens of a structure are walked once, not once per record."""
    rows = records(*[{"id1": 7 * i, 'q"2:': "x1" * i, "o": {"n": -i - 0.5, "l": [i, i + 1]}, "t": True} for i in range(300)], '{"a":"1","b":1}', '{"a":1,"b":"1"}', '["",1e5,[]]', "{} {}")
    found = rows.select(V.skeleton(F.col("value")).alias("s"), V.exact_structure(F.col("value")).alias("e"), V.describe(F.col("value")).alias("d"), "ordinal")
    got = {r.s: (r.e, r.d) for r in found.collect()}
    assert len(got) == 5
    assert set(got.values()) == {
        ('{id1=integer, o=object, o.l=array, o.l[]=integer, o.n=number, q"2:=string, t=boolean}',
         'id1 (integer), q"2: (string), o (object: n (number), l (array of integer)), t (boolean)'),
        ("{a=string, b=integer}", "a (string), b (integer)"),
        ("{a=integer, b=string}", "a (integer), b (string)"),
        ("{_root=array, _root[]=string}", "array"),
        (None, None),
    }


def test_describe(records):
    rows = records({"userName": "a", "age": 1, "o": {"x": 1}, "l": ["a"], "e": [], "m": [{"q": None}]})
    assert rows.select(V.describe(F.col("value"))).first()[0] == (
        "userName (string), age (integer), o (object: x (integer)), l (array of string), e (array), m (array of q (null))"
    )


def test_discovery(records):
    rows = records(*[{"id": i, "name": f"n{i}", "kind": "ab"[i % 2], **({"opt": 1.5} if i % 3 else {})} for i in range(12)])
    schema = P.discover_schema(rows, enum_max=3)
    assert schema["properties"]["id"] == {"type": "integer"}
    assert schema["properties"]["kind"] == {"type": "string", "enum": ["a", "b"]}
    assert schema["properties"]["name"] == {"type": "string"}
    assert schema["properties"]["opt"] == {"type": "number"}
    assert schema["required"] == ["id", "kind", "name"]
    assert P.is_discovered_schema(json.dumps(schema)) and not P.is_discovered_schema("[]")
