"""Queries for contracts, privacy, batches and model calls."""

from __future__ import annotations

# The message texts in the SQL below are fixed values.

from pyspark.sql import functions as F

from ..functions import variant as V
from ..operators import batching as B
from ..operators import contract as C
from ..operators import model as L
from ..operators import privacy as P
from ..operators.staging import compute_once
from .base import Tables, got, query

# ---------------------------------------------------------------- contracts

STRICT = C.Contract.parse(
    {
        "type": "object",
        "properties": {
            "id": {"type": "integer"},
            "status": {"type": "string", "enum": ["O", "F"]},
            "price": {"type": "number"},
            "tags": {"type": "array"},
            "extra": {"type": "whatever"},
        },
        "required": ["id", "status"],
    }
)


def mixed_quality(t: Tables):
    """Orders as records; by key some lack a field, carry a wrong type, are a list, or are cut short."""
    return t.wide("orders").selectExpr(
        "o_orderkey ordinal",
        "concat('k', o_orderkey) key",
        """case o_orderkey % 8
             when 0 then '[1,2]' when 1 then '{"id":'
             when 2 then to_json(named_struct('id', o_orderkey))
             when 3 then to_json(named_struct('id', cast(o_orderkey as string), 'status', 'O', 'price', 'x', 'tags', 7))
             when 4 then '{"id":null,"status":null,"price":null,"extra":[1]}'
             else to_json(named_struct('id', o_orderkey, 'status', o_orderstatus, 'price', o_totalprice, 'tags', array(1))) end value""",
    )


_ERRORS_SQL = """SELECT o_orderkey AS ordinal, CASE o_orderkey % 8
    WHEN 0 THEN 'Expected JSON object but got: ARRAY'
    WHEN 1 THEN 'Schema validation failed: not valid JSON'
    WHEN 2 THEN 'Missing required field: status'
    WHEN 3 THEN 'Field ''id'' expected integer but got STRING|Field ''price'' expected number but got STRING|Field ''tags'' expected array but got NUMBER'
    WHEN 4 THEN ''
    ELSE CASE WHEN o_orderstatus IN ('O', 'F') THEN '' ELSE 'Field ''status'' value ''' || o_orderstatus || ''' not in allowed values: [O, F]' END
  END AS errors FROM orders"""


@query("V1-V5", _ERRORS_SQL)
def contract_errors(t: Tables):
    return C.validate(mixed_quality(t), STRICT).select("ordinal", F.array_join("errors", "|").alias("errors"))


@query(
    "V2",
    """SELECT c_custkey AS ordinal, c_custkey % 3 = 0 AS lacks_segment, c_custkey % 5 <> 0 AS lacks_note FROM customer""",
)
def required_fields(t: Tables):
    """Without a required list every property is required; an explicit null is present."""
    contract = C.Contract.parse({"properties": {"mktSegment": {}, "note": {}}})
    out = C.validate(t.flat_json(), contract)
    return out.select(
        "ordinal",
        F.array_contains("errors", "Missing required field: mktSegment").alias("lacks_segment"),
        F.array_contains("errors", "Missing required field: note").alias("lacks_note"),
    )


@query(
    "V3",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber % 2 = 0 AS whole_ok, TRUE AS number_ok,
          l_returnflag <> 'R' AS flag_ok FROM lineitem""",
)
def type_checks(t: Tables):
    """1.0 is a number but not an integer; a quoted truth value is not a boolean."""
    records = t.wide("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        """concat('{"whole":', l_linenumber, case when l_linenumber % 2 = 0 then '' else '.0' end,
             ',"number":', l_quantity, ',"flag":', case when l_returnflag = 'R' then '"true"' else 'true' end, '}') value""",
    )
    contract = C.Contract.parse(
        {"properties": {"whole": {"type": "integer"}, "number": {"type": "number"}, "flag": {"type": "boolean"}}}
    )
    out = C.validate(records, contract)
    ok = lambda name: ~F.exists("errors", lambda e: e.contains(f"'{name}'"))
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        ok("whole").alias("whole_ok"), ok("number").alias("number_ok"), ok("flag").alias("flag_ok"),
    )


@query(
    "V4",
    """SELECT doc_id, (quality = 1) AND (toxic = 0) AS ok FROM labels""",
)
def enum_checks(t: Tables):
    """Enum values are compared by their text form."""
    records = t.wide("labels").selectExpr("doc_id", "to_json(named_struct('quality', quality, 'toxic', cast(toxic as string))) value")
    contract = C.Contract.parse({"properties": {"quality": {"enum": [1]}, "toxic": {"enum": ["0"]}}})
    return C.validate(records, contract).select("doc_id", (F.size("errors") == 0).alias("ok"))


@query(
    "V5 (no contract)",
    "SELECT o_orderkey AS ordinal, o_orderkey % 8 <> 1 AS ok FROM orders",
)
def valid_json_only(t: Tables):
    return C.validate(mixed_quality(t), C.Contract()).select("ordinal", (F.size("errors") == 0).alias("ok"))


@query(
    "V6",
    f"""SELECT errors = '' AS good, count(*) AS records, CAST(sum(ordinal) AS BIGINT) AS key_sum FROM ({_ERRORS_SQL}) GROUP BY 1""",
)
def good_bad_split(t: Tables):
    good, bad = C.split(C.validate(mixed_quality(t), STRICT))
    both = good.select("ordinal", F.lit(True).alias("good")).unionByName(bad.select("ordinal", F.lit(False).alias("good")))
    return both.groupBy("good").agg(F.count(F.lit(1)).alias("records"), F.sum("ordinal").alias("key_sum"))


@query(
    "V7",
    f"""SELECT ordinal, 'k' || ordinal AS key, replace(errors, '|', '; ') AS error_message, 'SchemaViolation' AS error_class,
               'transform' AS stage FROM ({_ERRORS_SQL}) WHERE errors <> ''""",
)
def dead_letters(t: Tables):
    _, bad = C.split(C.validate(mixed_quality(t), STRICT))
    return C.to_dead_letter(bad, "transform").select("ordinal", "key", "error_message", "error_class", "stage")


def lossy_outputs(t: Tables):
    inputs = t("orders").selectExpr("o_orderkey div 50 batch_id", "cast(o_orderkey % 50 as int) ordinal", "o_orderkey")
    return inputs, inputs.filter("o_orderkey % 173 <> 5")


@query(
    "V8",
    """SELECT o_orderkey // 50 AS batch_id, count(*) AS expected, count(*) FILTER (o_orderkey % 173 <> 5) AS produced
       FROM orders GROUP BY 1 HAVING count(*) <> count(*) FILTER (o_orderkey % 173 <> 5)""",
)
def count_drift(t: Tables):
    return C.count_drift(*lossy_outputs(t))


@query(
    "V8 (rows to redo)",
    "SELECT o_orderkey // 50 AS batch_id, o_orderkey % 50 AS ordinal, o_orderkey FROM orders WHERE o_orderkey % 173 = 5",
)
def missing_outputs(t: Tables):
    return C.missing_outputs(*lossy_outputs(t)).withColumn("ordinal", F.col("ordinal").cast("bigint"))


# ------------------------------------------------------------------ privacy


def personal(t: Tables):
    """Customers as nested records with names, mail addresses and quotes."""
    return t.wide("customer").selectExpr(
        "c_custkey",
        """concat('{"Name":"', c_name, ' \\\\"Q\\\\"", "id":', c_custkey,
             ',"contact":{"EMAIL" : "c', c_custkey, '@example.org","tags":["vip","mail c', c_custkey, '@example.org"]},',
             '"ssn":', case when c_custkey % 2 = 0 then '"123-45-6789"' else '123456789' end,
             ',"note":"seg ', c_mktsegment, ': {\\\\"email\\\\":\\\\"x\\\\"}"}') value""",
    )


_MAIL = "[a-z0-9]+@[a-z]+\\.[a-z]+"


@query(
    "M1, M2",
    """SELECT c_custkey, '[MASKED_0]' AS name, '[MASKED_1]' AS email, 'vip' AS tag0, '[MASKED_2]' AS tag1,
         CASE WHEN c_custkey % 2 = 0 THEN '[MASKED_3]' ELSE '123456789' END AS ssn,
         'seg ' || c_mktsegment || ': {"email":"x"}' AS note, c_custkey AS id FROM customer""",
)
def masked_records(t: Tables):
    """By name in any case and depth (text values only), by pattern inside any text value."""
    out = P.mask(personal(t), ["name", "email", "ssn"], [_MAIL])
    return out.select(
        "c_custkey",
        got("value", "$.Name").alias("name"),
        got("value", "$.contact.EMAIL").alias("email"),
        got("value", "$.contact.tags[0]").alias("tag0"),
        got("value", "$.contact.tags[1]").alias("tag1"),
        got("value", "$.ssn").alias("ssn"),
        got("value", "$.note").alias("note"),
        got("value", "$.id", "bigint").alias("id"),
    )


@query(
    "M2 (whole texts)",
    """SELECT doc_id, regexp_matches(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+[.][a-z]+') AS masked,
         CASE WHEN regexp_matches(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+[.][a-z]+') THEN md5('[MASKED_0]') ELSE md5(text) END AS text_md5,
         lang FROM documents""",
)
def masked_documents(t: Tables):
    records = t.wide("documents").select("doc_id", F.to_json(F.struct("text", "lang")).alias("value"))
    out = P.mask(records, [], [r"[A-Za-z0-9._]+@[A-Za-z0-9.]+[.][a-z]+"])
    return out.select(
        "doc_id",
        (F.size("mask_map") > 0).alias("masked"),
        F.md5(got("value", "$.text")).alias("text_md5"),
        got("value", "$.lang").alias("lang"),
    )


@query(
    "M3",
    """SELECT c_custkey, '[MASKED_0]' AS placeholder, c_name || ' "Q"' AS original FROM customer
       UNION ALL SELECT c_custkey, '[MASKED_1]', 'c' || c_custkey || '@example.org' FROM customer
       UNION ALL SELECT c_custkey, '[MASKED_2]', 'mail c' || c_custkey || '@example.org' FROM customer""",
)
def mask_map(t: Tables):
    out = P.mask(personal(t), ["name"], [_MAIL])
    return out.select("c_custkey", F.explode("mask_map").alias("placeholder", "original"))


@query(
    "M4, M5",
    """SELECT doc_id, md5(text) AS text_md5, TRUE AS unchanged FROM documents""",
)
def mask_round_trip(t: Tables):
    """Mask, work on the masked record, unmask: the original texts come back."""
    records = t.wide("documents").select("doc_id", F.to_json(F.struct("doc_id", "text")).alias("value"), F.col("text").alias("original"))
    out = P.masked_stage(records, lambda df: df.withColumn("seen", F.col("value")), ["text"])
    return out.select(
        "doc_id",
        F.md5(got("value", "$.text")).alias("text_md5"),
        ((got("value", "$.text") == F.col("original")) & (got("seen", "$.text") == "[MASKED_0]")).alias("unchanged"),
    )


# ------------------------------------------------------------------ batches

_BATCHED = """SELECT o_orderkey, (rn - 1) // 100 AS batch_id, (rn - 1) % 100 AS ordinal FROM
   (SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS rn FROM orders)"""


@query("B1", _BATCHED)
def size_batches(t: Tables):
    out = B.assign_batches(t("orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], 100)
    return out.select("o_orderkey", "batch_id", F.col("ordinal").cast("bigint").alias("ordinal"))


@query(
    "B3",
    f"""WITH b AS ({_BATCHED}), n AS (SELECT batch_id, count(*) AS c FROM b GROUP BY 1)
        SELECT o_orderkey, batch_id, CASE WHEN c > 8 THEN ordinal // greatest(1, c // 8) ELSE 0 END AS sub_batch
        FROM b JOIN n USING (batch_id)""",
)
def sub_batches(t: Tables):
    out = B.assign_batches(t("orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], 100)
    return B.split_batches(out, 8).select("o_orderkey", "batch_id", F.col("sub_batch").cast("bigint").alias("sub_batch"))


@query(
    "B4",
    """SELECT o_orderkey // 100 AS batch_id, count(*) AS results, TRUE AS in_order FROM orders GROUP BY 1""",
)
def ordered_results(t: Tables):
    """Work done out of order, results back in input order within every batch."""
    rows = t("orders").selectExpr("o_orderkey div 100 batch_id", "cast(o_orderkey % 100 as int) ordinal", "o_orderkey")
    shuffled = rows.repartition(7, F.xxhash64("o_orderkey"))
    back = B.in_order(shuffled).withColumn("_at", F.monotonically_increasing_id())
    ordered = F.array_sort(F.collect_list(F.struct("_at", "ordinal")))
    seen = F.transform(ordered, lambda s: s["ordinal"])
    return back.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("results"), (seen == F.array_sort(seen)).alias("in_order")
    )


@query(
    "B5",
    """SELECT batch_id, count(*) AS records, min(role || ':' || turn) FILTER (pos = 0) AS first_record,
              md5(string_agg(text, '|' ORDER BY pos)) AS texts_md5 FROM
       (SELECT role, turn, text, (rn - 1) // 25 AS batch_id, (rn - 1) % 25 AS pos FROM
         (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM conversations)) GROUP BY 1""",
)
def batch_json(t: Tables):
    """Conversation turns as JSON arrays of at most 25 records, in order, whole texts."""
    rows = t("conversations").selectExpr(
        "conv_id",
        "turn",
        "concat(role, ':', turn) key",
        "text value",
        "cast(case when turn = 0 then map('first', 'yes') else map() end as map<string,string>) metadata",
    )
    out = B.serialize_batches(B.assign_batches(rows, ["conv_id", "turn"], 25))
    items = F.from_json("batch_json", "array<struct<key:string,value:string>>")
    return out.select(
        "batch_id",
        F.size(items).cast("bigint").alias("records"),
        F.get(items, 0)["key"].alias("first_record"),
        F.md5(F.array_join(F.transform(items, lambda i: i["value"]), "|")).alias("texts_md5"),
    )


# -------------------------------------------------------------- model calls


def small_batches(t: Tables):
    return t("orders").selectExpr(
        "o_orderkey div 25 batch_id",
        "cast(o_orderkey % 25 as int) ordinal",
        "concat('k', o_orderkey) key",
        "to_json(named_struct('orderId', o_orderkey, 'state', o_orderstatus, 'total', o_totalprice)) value",
    )


@query(
    "L1",
    """SELECT o_orderkey // 25 AS batch_id, count(*) AS records, TRUE AS counted, TRUE AS has_contract, TRUE AS has_input
       FROM orders GROUP BY 1""",
)
def prompts(t: Tables):
    built = L.build_prompts(B.serialize_batches(small_batches(t)), "You map orders.", STRICT)
    return built.select(
        "batch_id",
        F.col("records").cast("bigint").alias("records"),
        F.col("user_prompt").contains(F.concat(F.lit("exactly "), F.col("records").cast("string"))).alias("counted"),
        (F.col("system_prompt").startswith("You map orders.") & F.col("system_prompt").contains(STRICT.text)).alias("has_contract"),
        (F.col("user_prompt").endswith(F.col("batch_json")) & F.col("correction_prompt").endswith(F.col("batch_json"))).alias("has_input"),
    )


def _answered(t: Tables):
    client = L.MappingClient({"id": "orderId", "status": "state", "price": "total"})
    return L.complete(L.build_prompts(B.serialize_batches(small_batches(t)), "Map.", STRICT), client, wait_seconds=0.0)


@query(
    "L3",
    """SELECT o_orderkey // 25 AS batch_id, count(*) AS items, 1 AS attempts, TRUE AS answered FROM orders GROUP BY 1""",
)
def model_answers(t: Tables):
    """One call per batch through a deterministic client."""
    return _answered(t).select(
        "batch_id",
        F.json_array_length("content").cast("bigint").alias("items"),
        "attempts",
        (F.col("call_error").isNull() & (F.col("output_tokens") > 0)).alias("answered"),
    )


@query(
    "L4",
    """SELECT event_id, event_type || '/' || event_id AS content, user_id AS input_tokens, event_id % 50 AS output_tokens,
         CASE WHEN event_id % 2 = 0 THEN 7 ELSE 0 END AS cache_create_tokens, event_id % 9 AS cache_read_tokens,
         'm-' || (event_id % 3) AS model, CASE WHEN event_id % 2 = 0 THEN 'end_turn' ELSE 'stop' END AS stop_reason FROM events""",
)
def response_parse(t: Tables):
    """Answer bodies of two providers, content in blocks or in a message."""
    events = t.wide("events")
    first = events.filter("event_id % 2 = 0").selectExpr(
        "event_id",
        """to_json(named_struct('content', array(named_struct('type', 'text', 'text', event_type),
             named_struct('type', 'thinking', 'text', 'no'), named_struct('type', 'text', 'text', concat('/', event_id))),
             'model', concat('m-', event_id % 3), 'stop_reason', 'end_turn', 'usage', named_struct('input_tokens', user_id,
             'output_tokens', event_id % 50, 'cache_creation_input_tokens', 7, 'cache_read_input_tokens', event_id % 9))) body""",
    )
    second = events.filter("event_id % 2 = 1").selectExpr(
        "event_id",
        """to_json(named_struct('choices', array(named_struct('message', named_struct('content', concat(event_type, '/', event_id)),
             'finish_reason', 'stop')), 'model', concat('m-', event_id % 3), 'usage', named_struct('prompt_tokens', user_id,
             'completion_tokens', event_id % 50, 'prompt_tokens_details', named_struct('cached_tokens', event_id % 9)))) body""",
    )
    return L.parse_response(first, "anthropic").unionByName(L.parse_response(second, "openai")).drop("body")


@query(
    "L5",
    """SELECT o_orderkey // 25 AS batch_id, o_orderkey % 25 AS ordinal, 'k' || o_orderkey AS key, o_orderkey AS id,
              o_totalprice AS price, o_orderstatus IN ('O', 'F') AS ok FROM orders""",
)
def aligned_results(t: Tables):
    """Answers back to records by position, checked one by one."""
    out = L.align_results(small_batches(t), _answered(t), STRICT)
    out = compute_once(out, {"v": V.parse(F.col("value"))})
    return out.select(
        "batch_id",
        F.col("ordinal").cast("bigint").alias("ordinal"),
        "key",
        F.try_variant_get("v", "$.id", "bigint").alias("id"),
        F.try_variant_get("v", "$.price", "double").alias("price"),
        (F.size("errors") == 0).alias("ok"),
    )


@query(
    "L5 (own keys and surplus)",
    """SELECT c_custkey AS batch_id, 0 AS ordinal, 'own-' || c_custkey AS key FROM customer
       UNION ALL SELECT c_custkey, 1, 'in-1' FROM customer UNION ALL SELECT c_custkey, 2, NULL FROM customer""",
)
def surplus_results(t: Tables):
    customers = t("customer").select(F.col("c_custkey").alias("batch_id"))
    inputs = customers.select("batch_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("ordinal")).withColumn(
        "key", F.concat(F.lit("in-"), F.col("ordinal").cast("string"))
    )
    answers = customers.withColumn(
        "content", F.concat(F.lit('{"results":[{"key":"own-'), F.col("batch_id").cast("string"), F.lit('"},{"a":1},{"a":2}]}'))
    )
    return L.align_results(inputs, answers).select("batch_id", F.col("ordinal").cast("bigint").alias("ordinal"), "key")


@query("L6", "SELECT doc_id, TRUE AS unit_length, 64 AS dimensions FROM documents")
def text_vectors(t: Tables):
    """Each distinct text is embedded once, over its whole length."""
    out = L.embed(t.wide("documents").select("doc_id", "text"), L.HashEmbedder(64))
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return out.select("doc_id", (F.abs(norm - 1.0) < 1e-4).alias("unit_length"), F.size("embedding").alias("dimensions"))


