"""Nested discovery against a plain walk over parsed records."""

import json
from collections import Counter

import pyarrow as pa
import pytest

from recordflow.operators import discovery as D
from recordflow.operators.contract import Contract, split, validate
from recordflow.plans.config import FlowConfig
from recordflow.plans.flow import Pipeline


def kind(v):
    names = {dict: "object", list: "array", str: "string", bool: "boolean", int: "integer", float: "number", type(None): "null"}
    return names[type(v)]


def walked(values):
    """Counts of (path, kind), each object's names taken as they are."""
    out = Counter()

    def walk(path, v):
        out[path, kind(v)] += 1
        if isinstance(v, dict):
            for k, x in v.items():
                walk(path + (f".{k}" if D._PLAIN.fullmatch(k) else json.dumps([k], ensure_ascii=False, separators=(",", ":"))), x)
        elif isinstance(v, list):
            for x in v:
                walk(f"{path}[]", x)

    for v in values:
        walk("$", v)
    return out


def found(counts):
    return Counter({(r.path, r.kind): r.occurrences for r in counts.collect()})


NESTED = [
    {"id": 1, "a": {"b": [{"c": 1}, {"c": 2.5, "d": None}], "e.f": "x", "": True}},
    {"id": "2", "a": {"b": [], "e.f": "y", "[]": [[1, [2]], "s"]}, "more": {"": {}}},
    {"id": None, "a": [1, "z"], "naïve \"q\"": {"n": 1}},
    {"id": 1, "a": {"b": [{"c": 3}]}},
    [1, {"a": 1}],
    "text",
    7,
    None,
]


def test_paths_of_nested_records(records):
    bad = ['{"a":', '{"a":1,"a":2}', "", None]
    counts = D.discover_paths(records(*[json.dumps(v, ensure_ascii=False) for v in NESTED], *bad))
    assert found(counts) == walked(NESTED)
    values = {(r.path, r.kind): (r.first_value, r.last_value) for r in counts.collect()}
    assert values["$.id", "integer"] == ("1", "1") and values['$.a["e.f"]', "string"] == ("x", "y") and values["$.a", "object"] == (None, None)


def test_objects_whose_keys_are_data(records):
    values = [{"by": {f"user-{i}": {"n": i}, f"u{i + 1}": {"n": 0}}, "fixed": {f"f{j}": j for j in range(60)}} for i in range(80)]
    counts = {(r.path, r.kind): r.occurrences for r in D.discover_paths(records(*values)).collect()}
    assert counts["$.by.*", "object"] == 160 and counts["$.by.*.n", "integer"] == 160
    # Many names that every object has are fields.
    assert counts["$.fixed.f59", "integer"] == 80 and len(counts) == 65
    few = D.discover_paths(records(*values[:20]))
    assert ("$.by.u3", "object") in found(few)
    schema = D.nested_schema(D.discover_paths(records(*values)))
    by = schema["properties"]["by"]
    assert by["properties"] == {} and by["required"] == [] and by["additionalProperties"]["properties"] == {"n": {"type": "integer"}}


def test_types_join_and_parts_merge(records):
    whole = D.discover_paths(records(*NESTED[:4]))
    merged = D.merge_paths(D.discover_paths(records(*NESTED[:2])), D.discover_paths(records(*NESTED[2:4])))
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    rows = {r.path: r for r in D.path_types(whole).collect()}
    assert rows["$.a.b[].c"].kinds == ["number"] and rows["$.a.b[].c"].required
    assert rows["$.a.b[].d"].nullable and rows["$.a.b[].d"].kinds == [] and not rows["$.a.b[].d"].required
    assert sorted(rows["$.id"].kinds) == ["integer", "string"] and rows["$.id"].nullable and rows["$.id"].required
    assert rows["$.a.b"].required and not rows["$.more"].required and not rows["$.a.b[]"].required


def test_schema_of_nested_records(records):
    schema = D.nested_schema(D.discover_paths(records(*NESTED[:4])))
    a = schema["properties"]["a"]
    assert schema["type"] == "object" and schema["required"] == ["a", "id"]
    assert sorted(a["type"]) == ["array", "object"] and a["required"] == ["b"] and sorted(a["items"]["type"]) == ["integer", "string"]
    assert a["properties"]["e.f"] == {"type": "string"} and a["properties"][""] == {"type": "boolean"}
    assert a["properties"]["b"]["items"]["properties"]["c"] == {"type": "number"}
    assert schema["properties"]['naïve "q"']["properties"] == {"n": {"type": "integer"}}
    assert D.nested_schema(D.discover_paths(records("{"))) == {"type": "object", "properties": {}, "required": []}


def test_a_flow_checks_what_it_discovered(records):
    right = records({"id": 1, "note": "a", "tags": {"x": 1}}, {"id": 2, "note": None, "tags": {}}, {"id": 3, "tags": {"x": 2}})
    flow = Pipeline.with_discovered_contract(FlowConfig(), right)
    assert flow.contract.required == ["id", "tags"] or set(flow.contract.required) == {"id", "tags"}
    checked = validate(records({"id": 9, "tags": {}}, {"id": "9", "tags": {}}, {"id": 1}, {"id": 4, "tags": {}, "note": "n"}), flow.contract)
    good, bad = split(checked)
    assert sorted(r.ordinal for r in good.collect()) == [0, 3] and sorted(r.ordinal for r in bad.collect()) == [1, 2]
    assert isinstance(flow.contract, Contract)


def test_deep_records_raise_instead_of_being_cut(records):
    deep = records("[" * 6 + "1" + "]" * 6)
    assert len(D.discover_paths(deep, most_levels=7).collect()) == 7
    with pytest.raises(ValueError):
        D.discover_paths(deep, most_levels=6)


def test_a_task_holds_one_row_per_path():
    """Texts are counted batch by batch, without sorting: many batches leave one row per path and kind."""
    names = ["path", "parent", "kind", "text"]
    texts = ["b", None, "\U0001f600", "￿", "", "a"]
    batches = [pa.RecordBatch.from_arrays([pa.array([v] * 6) for v in ("$.t", "$", "string")] + [pa.array(texts)], names=names) for _ in range(50)]
    batches.append(pa.RecordBatch.from_arrays([pa.array([v]) for v in ("$", "", "object")] + [pa.array([None], pa.string())], names=names))
    got = sorted(r for b in D._counted(iter(batches)) for r in zip(*b.to_pydict().values()))
    assert got == [("$", "", "object", 1, None, None), ("$.t", "$", "string", 300, "", "\U0001f600")]


def test_levels_are_counted_in_place(records, spark):
    """No level is dealt out by its parent, which would put all its rows into one task."""
    seen = []
    stored, D.materialise = D.materialise, lambda df: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or stored(df)
    try:
        D.discover_paths(records(*[{"a": {f"k{i}": {"n": i}}, "t": "x" * i} for i in range(80)]))
    finally:
        D.materialise = stored
    joins = [p for p in seen if "Join LeftOuter" in p]
    assert joins and all("strategy=broadcast" in p for p in joins)
    assert not any("min(" in p.split("MapInArrow")[-1] for p in joins)
