"""Reshaping of one record into another: path mappings, defaults, casts and SQL expressions."""

from __future__ import annotations

import json
import re
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import variant as V
from .staging import compute_once


def is_mapping_spec(text: str) -> bool:
    try:
        spec = json.loads(text)
    except ValueError:
        return False
    return isinstance(spec, dict) and isinstance(spec.get("mappings"), dict)


def _section(spec: dict, name: str) -> dict:
    part = spec.get(name)
    return part if isinstance(part, dict) else {}


def mapped(variant: Column, spec: dict) -> Column:
    """The output record of a mapping spec as JSON text; NULL when the input could not be parsed."""
    names, values = _resolved(variant, spec)
    casts = _section(spec, "typeCasts")
    outputs = [
        (V.cast_json(v, str(casts[n])) if n in casts else v).alias(n) for n, v in zip(names, values)
    ]
    return F.when(variant.isNotNull(), F.to_json(F.struct(*outputs)) if outputs else F.lit("{}"))


def _resolved(variant: Column, spec: dict) -> tuple[list[str], list[Column]]:
    """Output names in order, and their values before casting."""
    mappings, defaults = _section(spec, "mappings"), _section(spec, "defaults")
    names = [*mappings, *(n for n in defaults if n not in mappings)]
    values = []
    for name in names:
        # A path that is not a text resolves to nothing.
        path = mappings.get(name)
        value = V.json_path(variant, path) if isinstance(path, str) else F.lit(None).cast("variant")
        values.append(F.coalesce(value, V.literal(defaults[name])) if name in defaults else value)
    return names, values


def apply_mapping(df: DataFrame, spec: dict | str, value: str = "value", out: str | None = None) -> DataFrame:
    """Replace (or add) a JSON column by its mapped form.

    Steps, each computed once: parse, resolve paths, cast (schemas, texts,
    casts), write the output record.
    """
    spec = json.loads(spec) if isinstance(spec, str) else spec
    if not isinstance(spec.get("mappings"), dict):
        raise ValueError("a mapping spec needs an object under 'mappings'")
    casts = _section(spec, "typeCasts")
    df = compute_once(df, {"_parsed": V.parse(F.col(value))})
    names, values = _resolved(F.col("_parsed"), spec)
    if not names:
        return df.withColumn(out or value, F.when(F.col("_parsed").isNotNull(), F.lit("{}"))).drop("_parsed")
    found = {f"_f{i}": v for i, v in enumerate(values)}
    df = compute_once(df, found)
    cast = {i: str(casts[n]) for i, n in enumerate(names) if n in casts and str(casts[n]) in V.CAST_TARGETS}
    if cast:
        # Each text and cast once per value, in small steps: the JVM does not compile large methods.
        value_of, schema, text = (lambda i, c=c: F.col(f"_{c}{i}") for c in "fst")
        df = compute_once(df, {f"_s{i}": F.schema_of_variant(value_of(i)) for i in cast})
        df = compute_once(df, {f"_t{i}": V.cast_text(value_of(i), to, schema(i)) for i, to in cast.items()})
        changed = {i: V.changed_by_cast(value_of(i), to, partial(V.schema_is, schema(i)), text(i)) for i, to in cast.items()}
        df = compute_once(df, {f"_c{i}": c for i, c in changed.items()})
    outputs = []
    for i, n in enumerate(names):
        kept = F.col(f"_f{i}")
        if i in cast:
            # One name for both: fields that are NULL are not written, and one of them always is.
            outputs.append(F.col(f"_c{i}").alias(n))
            kept = F.when(F.col(f"_c{i}").isNull(), kept)
        outputs.append(kept.alias(n))
    written = F.when(F.col("_parsed").isNotNull(), F.to_json(F.struct(*outputs), {"ignoreNullFields": "true"}))
    return compute_once(df, {out or value: written}).drop("_parsed", *found, *[f"_{c}{i}" for c in "stc" for i in cast])


# Functions a user-written output expression may call: deterministic and without side effects.
ALLOWED_FUNCTIONS = frozenset(
    """abs array array_contains array_join array_size cardinality cast ceil char_length coalesce concat concat_ws
    date_format element_at exists filter floor get greatest if ifnull initcap instr least left length locate lower
    lpad ltrim map named_struct nullif nvl parse_json regexp_extract regexp_replace repeat replace reverse right
    round rpad rtrim sha2 size slice sort_array split startswith struct substr substring timestamp_millis
    timestamp_seconds to_date to_json to_timestamp transform trim try_cast try_divide try_parse_json
    try_to_timestamp try_variant_get upper""".split()
)


# Text literals in either kind of quotes; what is left of an expression has no text in it.
_LITERAL = r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\""


def check_expression(expression: str) -> str:
    """Reject all but calls of allowed functions before an expression reaches a plan.

    The names are taken from Spark's own parse of the expression, so quoting,
    qualifying, nesting or hiding a call in something that looks like text does not help.
    """
    bare = re.sub(_LITERAL, "''", expression, flags=re.DOTALL)
    if re.search(r"\b(select|from|join|union|insert|drop)\b|;|--|/\*", bare, re.IGNORECASE):
        raise ValueError(f"only a scalar expression is allowed: {expression}")
    session = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    try:
        parsed = session._jsparkSession.sessionState().sqlParser().parseExpression(expression)
    except Exception as failure:
        raise ValueError(f"not an expression: {expression}") from failure
    waiting = [parsed]
    while waiting:
        node = waiting.pop()
        kind = node.getClass().getSimpleName()
        if kind == "UnresolvedFunction":
            name = node.nameParts().mkString(".")
            if name.lower() not in ALLOWED_FUNCTIONS:
                raise ValueError(f"function not allowed in a transform: {name}")
        elif "Subquery" in kind or "Exists" in kind or "Plan" in kind or "Window" in kind:
            raise ValueError(f"only a scalar expression is allowed: {expression}")
        children = node.children()
        waiting.extend(children.apply(i) for i in range(children.size()))
    return expression


def expressed(outputs: dict[str, str]) -> Column:
    """JSON text of named SQL expressions; NULL results are left out."""
    return F.to_json(F.struct(*[F.expr(check_expression(e)).alias(n) for n, e in outputs.items()]))


def apply_sql_transform(
    df: DataFrame, outputs: dict[str, str], value: str = "value", out: str | None = None
) -> DataFrame:
    """Per-record transform: each output is a Spark SQL expression over ``input`` (the record as VARIANT)."""
    df = compute_once(df, {"input": V.parse(F.col(value))})
    return compute_once(df, {out or value: F.when(F.col("input").isNotNull(), expressed(outputs))}).drop("input")


def derive_columns(df: DataFrame, outputs: dict[str, str]) -> DataFrame:
    """Add derived fields (tiers, unit conversions, categories) to typed columns by the same expressions."""
    return df.withColumns({name: F.expr(check_expression(e)) for name, e in outputs.items()})
