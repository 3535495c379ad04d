import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordflow.operators import contract as C
from recordflow.operators import privacy as P

IDS = {"properties": {"id": {"type": "integer"}, "name": {"type": "string"}}, "required": ["id", "name"]}


def errors(rows, contract, **kw):
    out = C.validate(rows, C.Contract.parse(contract, **kw)).orderBy("ordinal").collect()
    return [list(r["errors"]) for r in out]


def test_required(records):
    assert errors(records({"id": 1, "name": "a"}, {"id": 1}, {"name": None, "id": None}), IDS) == [
        [], ["Missing required field: name"], [],
    ]


def test_no_contract(records):
    assert errors(records([1], '"text"', "{bad", ""), "") == [[], [], ["Invalid JSON"], []]


def test_not_an_object(records):
    got = errors(records([1], '"text"', "5", "true", "null", ""), IDS)
    assert [g[0].rsplit(" ", 1)[1] for g in got] == ["ARRAY", "STRING", "NUMBER", "BOOLEAN", "NULL", "MISSING"]


def test_enum(records):
    contract = {"properties": {"status": {"enum": ["active", "inactive", 3]}}}
    assert errors(records({"status": "active"}, {"status": "deleted"}, {"status": 3}, {"status": None}), contract) == [
        [], ["Field 'status' value 'deleted' not in allowed values: [active, inactive, 3]"], [], [],
    ]


@pytest.mark.parametrize(
    "declared, good, bad",
    [
        ("string", ["x", ""], [1, True, [], {}]),
        ("number", [1, 1.5, 12345678901234567890, 1e300], ["1", True]),
        ("integer", [1, -5, 12345678901234567890], [1.5, "1"]),
        ("boolean", [True, False], ["true", 0]),
        ("array", [[], [1], ["a", 1]], [{}, "[]"]),
        ("object", [{}, {"a": 1}], [[], "{}"]),
        ("anything", [1, "x", {}], []),
    ],
)
def test_types(records, declared, good, bad):
    got = errors(records(*[{"f": v} for v in [*good, *bad]]), {"properties": {"f": {"type": declared}}})
    assert [not g for g in got] == [True] * len(good) + [False] * len(bad)


def test_one_point_zero_is_not_an_integer(records):
    assert errors(records('{"f":1.0}'), {"properties": {"f": {"type": "integer"}}}) != [[]]


def test_contract_without_required(records):
    contract = {"properties": {"a": {}, "b": {}}}
    assert errors(records({"a": 1}), contract) == [["Missing required field: b"]]
    assert errors(records({"a": 1}), contract, strict=False) == [[]]


def test_unreadable_contract_keeps_object_check(records):
    assert errors(records({"a": 1}, [1]), "{nope") == [[], ["Expected JSON object but got: ARRAY"]]


def test_dead_letters(records):
    _, bad = C.split(C.validate(records({"id": 1, "name": "a"}, {"id": "x"}), C.Contract.parse(IDS)))
    row = C.to_dead_letter(bad, "s").first()
    assert row["key"] == "k1" and row["stage"] == "s" and "; " in row["error_message"] and row["error_ts"] is not None


# ------------------------------------------------------------------ privacy


def test_mask_by_name(records, read):
    rows = records({"name": "n", "SSN": "1", "email": "e", "deep": {"ssn": "2", "l": [{"Email": "x"}]}, "n2": {"ssn": 5}})
    out = P.mask(rows, ["ssn", "email"])
    assert read(out) == [
        {"name": "n", "SSN": "[MASKED_0]", "email": "[MASKED_1]", "deep": {"ssn": "[MASKED_2]", "l": [{"Email": "[MASKED_3]"}]}, "n2": {"ssn": 5}}
    ]
    assert out.first()["mask_map"] == {"[MASKED_0]": "1", "[MASKED_1]": "e", "[MASKED_2]": "2", "[MASKED_3]": "x"}


def test_mask_by_pattern(records, read):
    rows = records({"a": "id 123-45-6789.", "l": ["x", "123-45-6789"], "k": 123456789}, '"123-45-6789"', "not json 123-45-6789")
    out = P.mask(rows, [], [r"\d{3}-\d{2}-\d{4}"]).orderBy("ordinal").collect()
    assert json.loads(out[0]["value"]) == {"a": "[MASKED_0]", "l": ["x", "[MASKED_1]"], "k": 123456789}
    assert out[1]["value"] == '"[MASKED_0]"'
    assert out[2]["value"] == "[MASKED_0]" and out[2]["mask_map"] == {"[MASKED_0]": "not json 123-45-6789"}


BROKEN = ("{broken bob1@x.org", '{"a":1} tail bob3@x.org', '{"a":"x","a":"bob@x.org"}', '{"a": "bob@x.org', '"" bob@x.org "')


def test_broken_text_does_not_leak(records):
    rows = records(*BROKEN, '{"a":"fine"} tail', '{"email":"q", "a')
    masked = P.mask(rows, ["email"], [r"\w+@x\.org"])
    out = masked.orderBy("ordinal").collect()
    assert not any("@x" in r["value"] for r in out)
    assert out[5]["value"] == '{"a":"fine"} tail' and out[6]["value"] == '{"email":"[MASKED_0]", "a'
    assert [r["value"] for r in P.unmask(masked).orderBy("ordinal").collect()] == [r["value"] for r in rows.orderBy("ordinal").collect()]


def test_placeholders_in_the_record_stay_text(records, read):
    values = [
        {"a": "see [MASKED_0]", "email": "x@y"},
        {"email": "tell [MASKED_1]", "b": {"email": "secret"}, "c": "[MASKED_0] [x] [MASKED_"},
        {"email": 'quote " and \\ and [MASKED_0]'},
    ]
    masked = P.mask(records(*values), ["email"])
    assert not any("secret" in r["value"] or "x@y" in r["value"] for r in masked.collect())
    assert read(P.unmask(masked)) == values


def test_text_that_looks_like_a_field(records, read):
    rows = records({"note": '{"ssn":"1"}', "ssn": "2"}, '{ "ssn" :\n "3" }', '{"a":"1","a":"2","ssn":"4"}')
    out = P.mask(rows, ["ssn"]).orderBy("ordinal").collect()
    assert json.loads(out[0]["value"]) == {"note": '{"ssn":"1"}', "ssn": "[MASKED_0]"}
    assert json.loads(out[1]["value"]) == {"ssn": "[MASKED_0]"}
    assert '"4"' not in out[2]["value"]


def test_constant_style(records, read):
    out = P.mask(records({"ssn": "1"}), ["ssn"], style="constant", replacement="***")
    assert read(out) == [{"ssn": "***"}] and out.first()["mask_map"] == {}


def test_unmask_disabled(records):
    out = P.unmask(P.mask(records({"ssn": "1"}), ["ssn"]), enabled=False)
    assert json.loads(out.first()["value"]) == {"ssn": "[MASKED_0]"}


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**40), 2**40) | st.text(max_size=12),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["ssn", "a", "Email", 'q"q', "b:c"]), inner, max_size=3),
    max_leaves=10,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(json_values, min_size=20, max_size=30))
def test_unmask_restores(records, read, values):
    rows = records(*[json.dumps(v) for v in values])
    masked = P.mask(rows, ["ssn", "email"], ["[A-Z]"])
    assert read(P.unmask(masked)) == values
    for text in masked.select("value").collect():
        json.loads(text[0])
