"""Reading, typing, casting and profiling of JSON held as VARIANT or as text.

SQL NULL means "missing"; a VARIANT null means an explicit JSON null. The two
are kept apart everywhere, because the mapping rules treat them differently.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# A JSON string literal. The possessive groups keep the match iterative, so a
# literal of any length is matched without deep recursion in the regex engine.
STRING_LITERAL = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
# Larger indexes resolve to nothing.
MAX_INDEX = (1 << 31) - 1
LONG_TEXT = r"^[+-]?[0-9]+$"
DOUBLE_TEXT = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[dDfF]?\s*$"


def parse(text: Column) -> Column:
    """JSON text to VARIANT; NULL for bad JSON and for objects with duplicate keys."""
    return F.try_parse_json(text)


def is_parseable(text: Column, variant: Column | None = None) -> Column:
    """Blank text counts as parseable (an absent document), as in the source semantics."""
    parsed = variant if variant is not None else parse(text)
    return parsed.isNotNull() | (F.trim(text) == "")


def literal(value) -> Column:
    """A Python value as a constant VARIANT."""
    return F.parse_json(F.lit(json.dumps(value)))


def to_variant(col: Column) -> Column:
    return col.cast("variant")


def path_steps(path: str) -> list[str | int] | None:
    """Split ``$.a.b[0].c`` into steps; None when the path can never resolve."""
    trimmed = path[2:] if path.startswith("$.") else path
    steps: list[str | int] = []
    for part in re.sub(r"\.+$", "", trimmed).split("."):
        if "[" not in part:
            steps.append(part)
            continue
        name, _, rest = part.partition("[")
        index = rest.partition("]")[0]
        if not re.fullmatch(r"[+]?[0-9]+", index) or int(index) > MAX_INDEX:
            return None
        if name:
            steps.append(name)
        steps.append(int(index))
    return steps


def steps_of(path: Column) -> Column:
    """``path_steps`` of a path held as data: array of (name or null, index or null, ok)."""
    parts = F.split(F.regexp_replace(F.regexp_replace(path, r"^\$\.", ""), r"\.+$", ""), r"\.")

    def step(part: Column) -> Column:
        cut = part.contains("[")
        name = F.substring_index(part, "[", 1)
        digits = F.regexp_extract(part, r"^[^\[]*\[([^\]]*)", 1)
        number = F.when(digits.rlike("^[+]?[0-9]+$"), F.regexp_replace(digits, r"^[+]?0*(?=[0-9])", ""))
        index = F.when(F.length(number) <= 10, number.cast("bigint"))
        return F.struct(
            F.when(~(cut & (name == "")), name).alias("name"),
            F.when(cut, index).alias("index"),
            (~cut | F.coalesce(index <= MAX_INDEX, F.lit(False))).alias("ok"),
        )

    return F.transform(parts, step)


def follow(variant: Column, steps: Column) -> Column:
    """The value at steps held as data; resolves what ``json_path`` resolves."""

    def named(value: Column, name: Column) -> Column:
        single, double = name.contains("'"), name.contains('"')
        by_map = F.element_at(F.try_variant_get(value, "$", "map<string,variant>"), name)
        quote = F.when(double, F.lit("'")).otherwise(F.lit('"'))
        by_path = F.try_variant_get(value, F.concat(F.lit("$["), quote, name, quote, F.lit("]")), "variant")
        return F.when((name == "") | (single & double), by_map).otherwise(by_path)

    def move(value: Column, step: Column) -> Column:
        inner = F.when(step["name"].isNull(), value).otherwise(named(value, step["name"]))
        at = F.concat(F.lit("$["), F.coalesce(step["index"], F.lit(0)).cast("string"), F.lit("]"))
        found = F.when(step["index"].isNull(), inner).otherwise(F.try_variant_get(inner, at, "variant"))
        return F.when(step["ok"], found)

    resolvable = F.forall(steps, lambda s: s["ok"])
    return F.when(resolvable, F.aggregate(steps, variant, move))


def variant_path(steps: list[str | int]) -> str | None:
    """Steps as a VARIANT path literal; None when a key cannot be quoted."""
    out = ["$"]
    for step in steps:
        if isinstance(step, int):
            out.append(f"[{step}]")
        elif '"' not in step:
            out.append(f'["{step}"]')
        elif "'" not in step:
            out.append(f"['{step}']")
        else:
            return None
    return "".join(out)


def field(variant: Column, name: str, as_type: str = "variant") -> Column:
    """One top-level field; NULL when absent."""
    path = variant_path([name])
    if name == "" or path is None:
        found = F.element_at(F.try_variant_get(variant, "$", "map<string,variant>"), F.lit(name))
        return found if as_type == "variant" else F.try_variant_get(found, "$", as_type)
    return F.try_variant_get(variant, path, as_type)


def json_path(variant: Column, path: str) -> Column:
    """Resolve a mapping path: optional ``$.``, dots, one index per part; empty = whole record."""
    if path is None or path == "":
        return variant
    steps = path_steps(path)
    if steps is None:
        return F.lit(None).cast("variant")
    whole = variant_path(steps)
    if whole is not None and "" not in steps:
        return F.try_variant_get(variant, whole, "variant")
    current = variant
    for step in steps:
        if isinstance(step, int):
            current = F.try_variant_get(current, f"$[{step}]", "variant")
        else:
            current = field(current, step)
    return current


def text_of(variant: Column) -> Column:
    """Text form of a value: scalars as text, containers as the empty string."""
    return F.when(kind(variant).isin("object", "array"), F.lit("")).otherwise(
        F.when(F.is_variant_null(variant), F.lit("null")).otherwise(F.try_variant_get(variant, "$", "string"))
    )


_KINDS = {
    "STRING": "string",
    "BIGINT": "integer",
    "DECIMAL": "number",
    "DOUBLE": "number",
    "FLOAT": "number",
    "BOOLEAN": "boolean",
    "VOID": "null",
    "OBJECT": "object",
    "ARRAY": "array",
}


def kind(variant: Column) -> Column:
    """string, integer, number, boolean, array, object or null; NULL when missing.

    ``1.0`` is stored as DECIMAL(1,0), so a decimal without fraction is a number
    up to 18 digits (a whole number of that size would be BIGINT) and a big
    integer above. The VARIANT schema is computed once per call.
    """
    schema = F.regexp_replace(F.schema_of_variant(variant), r"^DECIMAL\((?:19|[23][0-9]),0\)$", "BIGINT")
    base = F.substring_index(F.substring_index(schema, "<", 1), "(", 1)
    return F.element_at(F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair]), base)


def schema_is(schema: Column, *kinds: str) -> Column:
    """Whether a value is of one of these kinds, by its VARIANT schema; for integer and number together without a regular expression."""
    names = {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}
    found = [schema == names[k] for k in kinds if k in names]
    found += [schema.startswith(k.upper() + "<") for k in kinds if k in ("object", "array")]
    decimal, floating = schema.startswith("DECIMAL("), schema.isin("DOUBLE", "FLOAT")
    big = schema.endswith(",0)") & schema.rlike(r"^DECIMAL\((?:19|[23][0-9]),0\)$")
    if "integer" in kinds:
        found += [schema == "BIGINT", decimal | floating if "number" in kinds else big]
    elif "number" in kinds:
        found += [floating, decimal & ~big]
    return reduce(or_, found)


def cast_text(variant: Column, target: str, schema: Column) -> Column:
    """The text that a cast of a value of this VARIANT schema reads, NULL if it reads none."""
    text = F.try_variant_get(variant, "$", "string")
    if target == "string":
        # Whole numbers and booleans are the same as JSON, without the cast that VARIANT builds per value.
        plain = F.when(schema.isin("BIGINT", "BOOLEAN"), F.to_json(variant))
        return plain.when(schema_is(schema, "integer", "number"), text)
    return F.when(schema_is(schema, "string"), text)


def root_kind(text: Column) -> Column:
    """The kind of a whole document, from the first character of its (valid) JSON text."""
    first = F.substring(F.regexp_replace(text, r"^\s++", ""), 1, 1)
    return (
        F.when(first == "{", "object")
        .when(first == "[", "array")
        .when(first == '"', "string")
        .when(first.isin("t", "f"), "boolean")
        .when(first == "n", "null")
        .otherwise("number")
    )


def is_text(variant: Column) -> Column:
    return F.schema_of_variant(variant) == "STRING"


CAST_TARGETS = ("integer", "number", "boolean", "string")


def changed_by_cast(variant: Column, target: str, is_a: Callable[..., Column], text: Column) -> Column | None:
    """The value as integer, number, boolean or string, as a typed column: NULL where it stays as it is; None for other targets.

    ``is_a`` tells whether it is of one of the kinds named.
    """
    number = F.try_variant_get(variant, "$", "double")
    if target == "integer":
        return F.when(
            is_a("string"), F.when(text.rlike(LONG_TEXT), text.try_cast("bigint"))
        ).when(is_a("number"), number.try_cast("bigint"))
    if target == "number":
        return F.when(is_a("string") & text.rlike(DOUBLE_TEXT), text.try_cast("double"))
    if target == "boolean":
        return F.when(is_a("string"), F.lower(text) == "true").when(
            is_a("integer", "number"), F.abs(number) >= 1
        )
    if target == "string":
        return F.when(is_a("object", "array"), F.lit("")).when(
            ~is_a("string", "null"), text
        )
    return None


def cast_json(variant: Column, target: str, of_kind: Column | None = None) -> Column:
    """Cast a value to integer, number, boolean or string; what cannot be cast stays as it is."""
    of_kind = kind(variant) if of_kind is None else of_kind
    changed = changed_by_cast(variant, target, lambda *kinds: of_kind.isin(*kinds), F.try_variant_get(variant, "$", "string"))
    return variant if changed is None else F.coalesce(to_variant(changed), variant)


# ---------------------------------------------------------------- text profile


def without_literals(text: Column) -> Column:
    return F.regexp_replace(text, STRING_LITERAL, "")


def field_count(text: Column) -> Column:
    """Object keys at every depth: one colon per key once literals are gone."""
    return count_of(without_literals(text), ":")


def count_of(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def brackets_of(bare: Column) -> Column:
    return F.regexp_replace(bare, r"[^\[\]{}]++", "")


def json_depth(text: Column) -> Column:
    """Nesting depth: 0 for a scalar, 1 plus the deepest child for a container."""
    return bracket_depth(brackets_of(without_literals(text)))


def bracket_depth(brackets: Column) -> Column:
    walked = F.aggregate(
        F.split(brackets, ""),
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("top")),
        lambda acc, ch: F.struct(
            (acc["at"] + _step(ch)).alias("at"),
            F.greatest(acc["top"], acc["at"] + _step(ch)).alias("top"),
        ),
        lambda acc: acc["top"],
    )
    # Taking out all innermost pairs takes one level; only deeper ones are walked bracket by bracket.
    left = F.translate(brackets, "[]", "{}")
    depth = F.when(left == "", 0)
    for level in range(1, 5):
        left = F.replace(left, F.lit("{}"), F.lit(""))
        depth = depth.when(left == "", level)
    return depth.otherwise(walked)


def _step(ch: Column) -> Column:
    return F.when(ch.isin("{", "["), 1).when(ch.isin("}", "]"), -1).otherwise(0)


# ------------------------------------------------------------ response cleanup


def strip_fences(text: Column) -> Column:
    """Drop a leading fence line and a trailing fence."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")
    opened = F.regexp_replace(bare, r"^```[^\n]*+\n", "")
    closed = F.regexp_replace(F.regexp_replace(opened, r"```$", ""), r"^\s+|\s+$", "")
    return F.when(bare.startswith("```"), closed).otherwise(bare)


def code_block(text: Column) -> Column:
    """Content between the first line and the last fence of a fenced answer, else the text itself."""
    bare = F.trim(text)
    inner = F.regexp_extract(bare, r"(?s)^```[^\n]*\n(.*)```", 1)
    return F.when(bare.rlike(r"(?s)^```[^\n]*\n.*```"), F.regexp_replace(inner, r"^\s+|\s+$", "")).otherwise(bare)


def first_array_field(text: Column, preferred: tuple[str, ...] = ()) -> Column:
    """The document as array<variant>: the root array, a preferred field, else the first array field in order."""
    parsed = parse(text)
    root = F.try_variant_get(parsed, "$", "array<variant>")
    named = [F.try_variant_get(field(parsed, name), "$", "array<variant>") for name in preferred]
    entries = F.from_json(text, "map<string,variant>")
    arrays = F.filter(F.map_values(entries), lambda v: F.schema_of_variant(v).startswith("ARRAY"))
    first = F.try_variant_get(F.get(arrays, 0), "$", "array<variant>")
    return F.coalesce(root, *named, first)


def first_json_array(text: Column) -> Column:
    """The array of a model answer as JSON text: the root array or the first array-valued field."""
    return F.to_json(first_array_field(text))


# ------------------------------------------------------------------- structure


def flat_structure(text: Column) -> Column:
    """``{a=string, b=integer}`` for records without nested values (key-sorted, value-free)."""
    entries = F.map_entries(F.from_json(text, "map<string,variant>"))
    keyed = F.array_sort(F.transform(entries, lambda e: F.struct(e["key"].alias("k"), kind(e["value"]).alias("t"))))
    return F.concat(
        F.lit("{"),
        F.array_join(F.transform(keyed, lambda p: F.concat(p["k"], F.lit("="), p["t"])), ", "),
        F.lit("}"),
    )


def deep_structure(variant: Column) -> Column:
    """Value-free description of a record of any depth, key-sorted, from its VARIANT schema.

    Decimals lose their precision (``1.5`` and ``10.25`` are one structure).
    All elements of an array are merged, where ``exact_structure`` looks at the
    first element only.
    """
    schema = F.schema_of_variant(variant)
    return F.regexp_replace(
        F.regexp_replace(schema, r"DECIMAL\((?:19|[23][0-9]),0\)", "BIGINT"),
        r"DECIMAL\([0-9]+,[0-9]+\)|FLOAT|DOUBLE",
        "NUMBER",
    )


def structure(text: Column, exact: bool = False) -> Column:
    """Value-free structure: in the JVM by default, or by the exact first-element rule."""
    return exact_structure(text) if exact else deep_structure(parse(text))


UNPARSEABLE = "{_raw=unparseable}"


def fingerprint_of(structure: Column, target_schema: str = "") -> Column:
    return F.sha2(F.concat(F.coalesce(structure, F.lit(UNPARSEABLE)), F.lit("|" + (target_schema or ""))), 256)


def fingerprint(text: Column, target_schema: str = "", mode: str = "deep") -> Column:
    """SHA-256 of structure and target contract. mode: flat or deep, in the JVM, or exact."""
    if mode == "flat":
        structure = flat_structure(text)
    elif mode == "deep":
        structure = deep_structure(parse(text))
    else:
        structure = exact_structure(text)
    return fingerprint_of(structure, target_schema)


def is_strict(text: Column) -> Column:
    """One JSON value and nothing behind it (the parser alone stops after the first value)."""
    in_array = parse(F.concat(F.lit("["), text, F.lit("]")))
    in_object = parse(F.concat(F.lit('{"v":'), text, F.lit("}")))
    one = F.try_variant_get(in_array, "$[0]", "variant").isNotNull() & F.try_variant_get(in_array, "$[1]", "variant").isNull()
    return F.coalesce(one & in_object.isNotNull(), F.lit(False))


def string_text(token: Column) -> Column:
    """The text of a JSON string token; only tokens with escapes go through the JSON reader."""
    escaped = F.get(F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>"), 0)
    return F.when(token.contains("\\"), escaped).otherwise(F.substring(token, F.lit(2), F.length(token) - 2))


# What is left of a text by ``skeleton``: keys with their mark, brackets and commas, and bare scalars.
_KEY, _SKELETON_TOKEN = r"\s*:0", re.compile(r'"(?:[^"\\]|\\.)*+"\s*:0|[{}\[\],]|[^\s{}\[\],:"]+')


def skeleton(text: Column) -> Column:
    """A JSON text without its values: ``"key":0`` for a key, ``s`` for a string, each run of digits as ``0``.

    All that ``exact_structure`` and ``describe`` look at is kept, so records alike in structure share one text.
    """
    no_strings = F.regexp_replace(text, f"({STRING_LITERAL}\\s*+:)|{STRING_LITERAL}", "$1s")
    return F.regexp_replace(no_strings, f"({STRING_LITERAL}\\s*+:)s|[0-9+-]++", "$10")


def _scalar_kind(token: str) -> str:
    if token in ("true", "false"):
        return "boolean"
    if token in ("s", "null"):
        return "string" if token == "s" else "null"
    return "number" if re.search("[.eE]", token) else "integer"


def _key_text(token: str) -> str:
    quoted = re.sub(_KEY + r"\Z", "", token)
    # Half of a surrogate pair becomes a question mark, as in the JVM.
    return json.loads(quoted).encode("utf-8", "replace").decode() if "\\" in quoted else quoted[1:-1]


def _walked(skeleton: str, out, entered, mark, scalar, left, shallow: bool):
    """Fold the tokens of a skeleton, of arrays the first element only.

    ``entered(out, top, name, token)``, ``scalar(out, top, name, token)`` and
    ``left(out, top)`` give the new result; ``mark(top, name, token)`` is kept with an
    open container and is the first of ``top`` (mark, is a list) for what is inside. ``shallow``: arrays
    that are not a field's value are not looked into.
    """
    inside, name, skip = [], "", 0
    for token in _SKELETON_TOKEN.findall(skeleton):
        top = inside[-1] if inside else None
        in_list = top is not None and top[1]
        if token in ("{", "["):
            if skip:
                skip += 1
                continue
            skip = int(shallow and token == "[" and (top is None or in_list))
            out = entered(out, top, name, token)
            inside.append((mark(top, name, token), token == "["))
        elif token in ("}", "]"):
            skip = max(skip - 1, 0)
            if not skip:
                out = left(out, top)
                inside.pop()
        elif skip:
            continue
        elif token == ",":
            skip = int(in_list)
        elif token[0] == '"':
            name = _key_text(token)
        else:
            out = scalar(out, top, name, token)
    return out


def _per_skeleton(text: Column, described) -> Column:
    """``described`` of the skeleton of each text that is one JSON value, found once per distinct skeleton of an Arrow batch."""

    @F.arrow_udf("string")
    def run(skeletons: pa.Array) -> pa.Array:
        coded = skeletons.dictionary_encode()
        return pa.array([described(s) for s in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)

    return run(F.when(is_strict(text), skeleton(text)))


def exact_structure(text: Column) -> Column:
    """Sorted path-to-kind text at any depth, first array element only; NULL for what is not one JSON value."""
    return _per_skeleton(text, _exact_structure)


def _exact_structure(skeleton: str) -> str:
    def place(top, name: str) -> str:
        if top is None:
            return ""
        return f"{top[0]}[]" if top[1] else f"{top[0]}.{name}" if top[0] else name

    def mark(top, name: str, token: str) -> str:
        at = place(top, name)
        return "_root" if token == "[" and at == "" else at

    def entry(out: dict, path: str, kind_: str) -> dict:
        out[path] = kind_  # a path that occurs twice (a dot within a name) keeps its last kind
        return out

    def entered(out: dict, top, name: str, token: str) -> dict:
        at = mark(top, name, token)
        return out if token == "{" and at == "" else entry(out, at, "array" if token == "[" else "object")

    found = _walked(
        skeleton, {}, entered, mark, lambda out, top, name, t: entry(out, place(top, name), _scalar_kind(t)),
        lambda out, top: out, shallow=False,
    )
    return "{" + ", ".join(f"{path}={found[path]}" for path in sorted(found)) + "}"


def describe(text: Column) -> Column:
    """``name (string), o (object: a (integer)), xs (array of string)``; NULL for what is not one JSON value."""
    return _per_skeleton(text, _described)


def _described(skeleton: str) -> str:
    def member(out: list, name: str) -> list:
        # A member always ends in a bracket, and what it may follow otherwise never does.
        return [*((", ",) if out and out[-1].endswith(")") else ()), name]

    def entered(out: list, top, name: str, token: str) -> list:
        is_list = token == "["
        if top is None:
            return ["array"] if is_list else []
        out += [" of ", "array"] if top[1] and is_list else [" of "] if top[1] else [*member(out, name), " (array" if is_list else " (object: "]
        return out

    def scalar(out: list, top, name: str, token: str) -> list:
        kind_ = _scalar_kind(token)
        if top is None:
            return [kind_]
        out += [" of ", kind_] if top[1] else [*member(out, name), " (", kind_, ")"]
        return out

    def left(out: list, top) -> list:
        out += [top[0]] if top[0] else []
        return out

    return "".join(_walked(skeleton, [], entered, lambda top, name, token: "" if top is None or top[1] else ")", scalar, left, shallow=True))
