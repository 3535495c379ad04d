"""The target contract: checks compiled to predicates, the good/bad split, dead letters and count drift."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V
from .staging import compute_once

# Accepted VARIANT schemas per declared type: (exact names, prefix).
_NUMBERS = ("BIGINT", "DOUBLE", "FLOAT")
_ACCEPTED = {
    "string": (("STRING",), None),
    "number": (_NUMBERS, "DECIMAL"),
    "numeric": (_NUMBERS, "DECIMAL"),
    "integer": (("BIGINT",), None),
    "boolean": (("BOOLEAN",), None),
    "array": ((), "ARRAY"),
    "object": ((), "OBJECT"),
}
_BIG_INTEGER = r"^DECIMAL\((?:19|[23][0-9]),0\)$"


def _as_text(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if value is None:
        return "null"
    return "" if isinstance(value, (dict, list)) else str(value)


@dataclass(frozen=True)
class Contract:
    """Required fields, field types and enums of a JSON Schema subset.

    Without a ``required`` list every property is required; ``strict=False``
    follows standard JSON Schema instead, where none is. A contract that cannot
    be read keeps only the check that the record is an object.
    """

    text: str = ""
    required: tuple[str, ...] = ()
    types: dict[str, str] = field(default_factory=dict)
    enums: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def active(self) -> bool:
        return bool(self.text)

    @staticmethod
    def parse(text: str | dict | None, strict: bool = True) -> "Contract":
        text = json.dumps(text) if isinstance(text, dict) else (text or "").strip()
        if not text:
            return Contract()
        try:
            schema = json.loads(text)
        except ValueError:
            return Contract(text)
        if not isinstance(schema, dict):
            return Contract(text)
        properties = schema.get("properties")
        properties = properties if isinstance(properties, dict) else {}
        listed = schema.get("required")
        if isinstance(listed, list):
            required = tuple(dict.fromkeys(_as_text(f) for f in listed))
        else:
            required = tuple(properties) if strict else ()
        types, enums = {}, {}
        for name, rule in properties.items():
            if not isinstance(rule, dict):
                continue
            if "type" in rule:
                types[name] = _as_text(rule["type"])
            if isinstance(rule.get("enum"), list):
                enums[name] = tuple(_as_text(v) for v in rule["enum"])
        return Contract(text, required, types, enums)


def error_list(variant: Column, text: Column, contract: Contract, fields: dict | None = None) -> Column:
    """All violations of one record as array<string>; empty when it conforms.

    ``fields`` may hold (value, VARIANT schema) columns computed beforehand per name.
    """
    bad_json = F.array(F.lit("Invalid JSON" if not contract.active else "Schema validation failed: not valid JSON"))
    none = F.array().cast("array<string>")
    if not contract.active:
        return F.when(V.is_parseable(text, variant), none).otherwise(bad_json)
    fields = fields if fields is not None else field_columns(variant, contract)
    checks = []
    # The texts of these messages are fixed values.
    for name in contract.required:
        checks.append(F.when(fields[name][0].isNull(), F.lit(f"Missing required field: {name}")))
    for name, expected in contract.types.items():
        if expected in _ACCEPTED:
            value, schema = fields[name]
            exact, prefix = _ACCEPTED[expected]
            fits = schema.isin("VOID", *exact)
            if prefix:
                fits = fits | schema.startswith(prefix)
            if expected == "integer":
                fits = fits | schema.rlike(_BIG_INTEGER)
            checks.append(
                F.when(
                    ~fits,
                    F.concat(
                        F.lit(f"Field '{name}' expected {'number' if expected == 'numeric' else expected} but got "),
                        _node_name(V.kind(value)),
                    ),
                )
            )
    for name, allowed in contract.enums.items():
        value, schema = fields[name]
        shown = V.text_of(value)
        checks.append(
            F.when(
                (schema != "VOID") & ~shown.isin(*allowed),
                F.concat(
                    F.lit(f"Field '{name}' value '"),
                    shown,
                    F.lit(f"' not in allowed values: [{', '.join(allowed)}]"),
                ),
            )
        )
    # Most records conform: their checks are not gathered.
    found = F.when(F.coalesce(*checks).isNull(), none).otherwise(F.array_compact(F.array(*checks))) if checks else none
    root = V.root_kind(text)
    # The texts of these messages are fixed values.
    blank = F.when(F.trim(text) == "", F.array(F.lit("Expected JSON object but got: MISSING")))
    return (
        F.when(variant.isNull(), F.coalesce(blank, bad_json))
        .when(~text.startswith("{") & (root != "object"), F.array(F.concat(F.lit("Expected JSON object but got: "), _node_name(root))))
        .otherwise(found)
    )


def field_columns(variant: Column, contract: Contract) -> dict[str, tuple[Column, Column]]:
    names = dict.fromkeys([*contract.required, *contract.types, *contract.enums])
    return {n: (V.field(variant, n), F.schema_of_variant(V.field(variant, n))) for n in names}


def _node_name(kind: Column) -> Column:
    return F.upper(F.when(kind == "integer", F.lit("number")).otherwise(kind))


def validate(df: DataFrame, contract: Contract, value: str = "value", out: str = "errors") -> DataFrame:
    """Adds the error list of every record: parse once, read each field once, then check."""
    df = compute_once(df, {"_parsed": V.parse(F.col(value))})
    parsed, text = F.col("_parsed"), F.col(value)
    read = {f"_c{i}": c for i, (c, _) in enumerate(field_columns(parsed, contract).values())}
    if not read:
        return compute_once(df, {out: error_list(parsed, text, contract)}).drop("_parsed")
    df = compute_once(df, read)
    df = compute_once(df, {f"_s{i}": F.schema_of_variant(F.col(c)) for i, c in enumerate(read)})
    fields = {
        n: (F.col(f"_c{i}"), F.col(f"_s{i}")) for i, n in enumerate(field_columns(parsed, contract))
    }
    return compute_once(df, {out: error_list(parsed, text, contract, fields)}).drop(
        "_parsed", *read, *[f"_s{i}" for i in range(len(read))]
    )


def split(df: DataFrame, errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """(good, bad). Both read the same frame: persist or materialise it first where its input is costly."""
    return df.filter(F.size(errors) == 0).drop(errors), df.filter(F.size(errors) > 0)


def to_dead_letter(
    bad: DataFrame, stage: str, errors: str = "errors", error_class: str = "SchemaViolation", at: Column | None = None
) -> DataFrame:
    """The rejected records with what went wrong, in which stage, and when."""
    return bad.withColumns(
        {
            "error_message": F.array_join(errors, "; "),
            "error_class": F.lit(error_class),
            "error_ts": at if at is not None else F.current_timestamp(),
            "stage": F.lit(stage),
        }
    ).drop(errors)


def count_drift(inputs: DataFrame, outputs: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Batches whose number of outputs differs from the number of inputs."""
    expected = inputs.groupBy(batch).agg(F.count(F.lit(1)).alias("expected"))
    produced = outputs.groupBy(batch).agg(F.count(F.lit(1)).alias("produced"))
    return (
        expected.join(produced, batch, "left")
        .withColumn("produced", F.coalesce("produced", F.lit(0)))
        .filter(F.col("expected") != F.col("produced"))
    )


def missing_outputs(inputs: DataFrame, outputs: DataFrame, keys: tuple[str, ...] = ("batch_id", "ordinal")) -> DataFrame:
    """Only the inputs without an output: what has to be redone one by one."""
    return inputs.join(outputs.select(*keys), list(keys), "left_anti")
