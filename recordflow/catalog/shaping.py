"""Queries for record shaping: mappings, casts, rules, cleanup, profiles, structures, routes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import variant as V
from ..operators import batching as B
from ..operators import discovery as D
from ..operators import mapping as M
from ..operators import profiling as PR
from ..operators import rules as RU
from ..operators.contract import Contract, split, validate
from ..operators.staging import compute_once
from .base import Tables, got, query

ORDER_SPEC = {
    "mappings": {
        "order_id": "$.orderId",
        "customer": "$.custId",
        "status": "orderStatus",
        "price": "$.totalPrice",
        "priority": "$.detail.level",
        "placed_on": "$.detail.dates.placedOn",
    },
    "defaults": {"source": "orders", "status": "?"},
    "typeCasts": {"customer": "integer", "price": "number"},
}
ORDER_CONTRACT = {
    "type": "object",
    "properties": {
        "order_id": {"type": "integer"},
        "customer": {"type": "integer"},
        "status": {"type": "string", "enum": ["O", "F"]},
        "price": {"type": "number"},
    },
    "required": ["order_id", "customer", "status", "price"],
}


@query(
    "T1-T4, V1-V6 end to end",
    """SELECT o_orderkey AS order_id, o_custkey AS customer, o_orderstatus AS status, o_totalprice AS price,
              o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m-%d') AS placed_on, 'orders' AS source
       FROM orders WHERE o_orderstatus IN ('O', 'F')""",
)
def mapped_and_checked_orders(t: Tables):
    mapped = M.apply_mapping(t.orders_json(), ORDER_SPEC)
    good, _ = split(validate(mapped, Contract.parse(ORDER_CONTRACT)))
    return compute_once(good, {"v": V.parse(F.col("value"))}).selectExpr(
        "variant_get(v, '$.order_id', 'bigint') order_id",
        "variant_get(v, '$.customer', 'bigint') customer",
        "variant_get(v, '$.status', 'string') status",
        "variant_get(v, '$.price', 'double') price",
        "variant_get(v, '$.priority', 'string') priority",
        "variant_get(v, '$.placed_on', 'string') placed_on",
        "variant_get(v, '$.source', 'string') source",
    )


@query(
    "T1, T2",
    """SELECT o_orderkey AS ordinal, o_orderkey % 7 AS first_code, o_orderkey % 11 AS second_code,
              strftime(o_orderdate, '%Y-%m-%d') AS placed_on, o_orderkey AS whole_id, 4 AS outputs FROM orders""",
)
def mapping_paths(t: Tables):
    """Array indexes, nesting, the whole record, and paths that resolve to nothing and are left out."""
    spec = {
        "mappings": {
            "first": "$.items[0].code",
            "second": "items[1].code",
            "third": "$.items[2].code",
            "placed": "$.detail.dates.placedOn",
            "through_text": "$.orderStatus.x",
            "absent": "$.nothing.here",
            "bare": "$",
            "whole": "",
        }
    }
    out = M.apply_mapping(t.orders_json(), spec, out="m")
    return out.select(
        "ordinal",
        got("m", "$.first", "bigint").alias("first_code"),
        got("m", "$.second", "bigint").alias("second_code"),
        got("m", "$.placed").alias("placed_on"),
        got("m", "$.whole.orderId", "bigint").alias("whole_id"),
        F.size(F.json_object_keys("m")).alias("outputs"),
    )


@query(
    "T3",
    """SELECT c_custkey AS ordinal, CASE WHEN c_custkey % 3 = 0 THEN 'none' ELSE c_mktsegment END AS segment,
              CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'empty' END AS note, 1 AS version, TRUE AS has_note,
              2 AS first_tag FROM customer""",
)
def mapping_defaults(t: Tables):
    """A default fills a missing field; an explicit null counts as present."""
    spec = {
        "mappings": {"segment": "$.mktSegment", "note": "$.note"},
        "defaults": {"segment": "none", "note": "empty", "version": 1, "tags": [2, 3]},
    }
    out = M.apply_mapping(t.flat_json(), spec, out="m")
    return out.select(
        "ordinal",
        got("m", "$.segment").alias("segment"),
        got("m", "$.note").alias("note"),
        got("m", "$.version", "int").alias("version"),
        F.array_contains(F.json_object_keys("m"), "note").alias("has_note"),
        got("m", "$.tags[0]", "int").alias("first_tag"),
    )


@query(
    "T4",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         l_orderkey AS int_from_text, CAST(trunc(l_extendedprice + 0.25) AS BIGINT) AS int_from_number,
         l_discount AS number_from_text, l_returnflag AS number_kept,
         l_linestatus = 'O' AS bool_from_text, l_tax >= 1 AS bool_from_number,
         CAST(l_linenumber AS VARCHAR) AS text_from_int, 'true' AS text_from_bool, '' AS text_from_object
       FROM lineitem""",
)
def mapping_casts(t: Tables):
    records = t.wide("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        """to_json(named_struct('a', cast(l_orderkey as string), 'b', l_extendedprice + 0.25D, 'c', cast(l_discount as string),
             'd', l_returnflag, 'e', case when l_linestatus = 'O' then 'TRUE' else 'no' end, 'f', l_tax,
             'g', l_linenumber, 'h', true, 'i', named_struct('x', 1))) value""",
    )
    names = "abcdefghi"
    casts = dict(zip(names, ["integer", "integer", "number", "number", "boolean", "boolean", "string", "string", "string"]))
    out = M.apply_mapping(records, {"mappings": {n: f"$.{n}" for n in names}, "typeCasts": casts})
    # The reader gives NULL where a value is not of the JSON kind the cast should have given, but takes anything as a string.
    types = "a bigint, b bigint, c double, d string, e boolean, f boolean, g string, h string, i string"
    out = compute_once(out, {"v": F.from_json("value", types)})

    def text(name: str):
        # to_json writes no blanks, and within a string each quote behind a backslash: this is the name, and a string.
        return F.when(F.col("value").contains(f'"{name}":"'), F.col("v")[name])

    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("v.a").alias("int_from_text"),
        F.col("v.b").alias("int_from_number"),
        F.col("v.c").alias("number_from_text"),
        text("d").alias("number_kept"),
        F.col("v.e").alias("bool_from_text"),
        F.col("v.f").alias("bool_from_number"),
        text("g").alias("text_from_int"),
        text("h").alias("text_from_bool"),
        text("i").alias("text_from_object"),
    )


@query(
    "T6",
    """SELECT c_custkey, lower(regexp_replace(
          lower(left(c_mktsegment, 2)) || upper(substr(c_mktsegment, 3, 1)) || lower(substr(c_mktsegment, 4)) || 'ID' || c_name,
          '([a-z])([A-Z])', '\\1_\\2', 'g')) AS snake FROM customer""",
)
def snake_names(t: Tables):
    name = F.expr(
        "concat(lower(left(c_mktsegment, 2)), upper(substr(c_mktsegment, 3, 1)), lower(substr(c_mktsegment, 4)), 'ID', c_name)"
    )
    return t.wide("customer").select("c_custkey", T.camel_to_snake(name).alias("snake"))


@query(
    "T7",
    """SELECT o_orderkey, o_custkey AS first_name, o_orderkey AS a_bc, o_orderstatus AS plain, o_totalprice AS in_name,
              4 AS fields, TRUE AS handled FROM orders""",
)
def field_rename(t: Tables):
    """firstName replaces an existing first_name; names inside nested objects stay."""
    records = t.wide("orders").selectExpr(
        "o_orderkey",
        """to_json(named_struct('first_name', 'old', 'firstName', o_custkey, 'aBC', o_orderkey, 'plain', o_orderstatus,
             'nestedPart', named_struct('inName', o_totalprice))) value""",
    )
    return RU.apply_patterns(records, ["field_rename"]).select(
        "o_orderkey",
        got("value", "$.first_name", "bigint").alias("first_name"),
        got("value", "$.a_bc", "bigint").alias("a_bc"),
        got("value", "$.plain").alias("plain"),
        got("value", "$.nested_part.inName", "double").alias("in_name"),
        F.size(F.json_object_keys("value")).alias("fields"),
        "handled",
    )


@query(
    "T8",
    """SELECT o_orderkey, o_custkey AS whole, o_totalprice AS amount, o_orderstatus = 'F' AS flag,
              o_orderpriority AS words, 'integer' AS whole_kind, 'boolean' AS flag_kind, '1.2.3' AS version, ' 5' AS blank
       FROM orders""",
)
def type_inference(t: Tables):
    records = t.wide("orders").selectExpr(
        "o_orderkey",
        """to_json(named_struct('whole', cast(o_custkey as string), 'amount', cast(o_totalprice as string),
             'flag', case when o_orderstatus = 'F' then 'True' else 'FALSE' end, 'words', o_orderpriority,
             'version', '1.2.3', 'blank', ' 5')) value""",
    )
    out = RU.apply_patterns(records, ["type_cast"]).withColumn("v", V.parse(F.col("value")))
    return out.select(
        "o_orderkey",
        F.try_variant_get("v", "$.whole", "bigint").alias("whole"),
        F.try_variant_get("v", "$.amount", "double").alias("amount"),
        F.try_variant_get("v", "$.flag", "boolean").alias("flag"),
        F.try_variant_get("v", "$.words", "string").alias("words"),
        V.kind(V.field(F.col("v"), "whole")).alias("whole_kind"),
        V.kind(V.field(F.col("v"), "flag")).alias("flag_kind"),
        F.try_variant_get("v", "$.version", "string").alias("version"),
        F.try_variant_get("v", "$.blank", "string").alias("blank"),
    )


@query(
    "T9",
    """SELECT event_id,
         strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS seconds,
         strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') ||
            CASE WHEN millisecond(ts) % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(millisecond(ts) % 1000 AS VARCHAR), 3, '0') END || 'Z' AS millis,
         strftime(date_trunc('second', ts) - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS shifted,
         event_type AS words, 'not a 2024-01-01T00:00:00Z' AS sentence FROM events""",
)
def timestamp_normalise(t: Tables):
    """Epoch seconds, epoch milliseconds and an offset time in one record, all to UTC instants."""
    records = t.wide("events").selectExpr(
        "event_id",
        """to_json(named_struct(
             'seconds', cast(unix_seconds(cast(ts as timestamp)) as string),
             'millis', cast(unix_millis(cast(ts as timestamp)) as string),
             'shifted', concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '+02:00'),
             'words', event_type, 'sentence', 'not a 2024-01-01T00:00:00Z')) value""",
    )
    out = RU.apply_patterns(records, ["timestamp_format"])
    return out.select("event_id", *[got("value", f"$.{n}").alias(n) for n in ("seconds", "millis", "shifted", "words", "sentence")])


@query(
    "T10",
    """WITH b AS (SELECT o_orderkey, o_orderkey // 50 AS batch_id, o_custkey,
                  CASE WHEN o_orderkey % 301 = 7 THEN 'list' WHEN o_orderkey % 11 = 0 THEN 'nothing' ELSE 'work' END AS kind FROM orders),
            w AS (SELECT batch_id, bool_and(kind = 'work') AS whole FROM b GROUP BY batch_id)
       SELECT o_orderkey, whole AS handled, CASE WHEN whole THEN o_custkey END AS cust_id FROM b JOIN w USING (batch_id)""",
)
def rules_on_batches(t: Tables):
    """All rules in order; one record that no rule applies to sends its batch elsewhere unchanged."""
    records = t.wide("orders").selectExpr(
        "o_orderkey",
        "o_orderkey div 50 batch_id",
        """case when o_orderkey % 301 = 7 then '[1]' when o_orderkey % 11 = 0 then '{"plain":1}'
             else concat('{"custId":"', o_custkey, '"}') end value""",
    )
    out = RU.apply_patterns(records, batch_semantics=True)
    return out.select("o_orderkey", "handled", F.when(F.col("handled"), got("value", "$.cust_id", "bigint")).alias("cust_id"))


@query(
    "T10 (order of rules)",
    """SELECT event_id, epoch_us(ts) // 1000000 AS cast_first,
              strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS time_first FROM events""",
)
def rule_order(t: Tables):
    """Casting first turns an epoch text into a number, which the timestamp rule then leaves alone."""
    records = t.wide("events").selectExpr(
        "event_id", "to_json(named_struct('at', cast(unix_seconds(cast(ts as timestamp)) as string))) value"
    )
    one = RU.apply_patterns(records.withColumn("other", F.col("value")), ["type_cast", "timestamp_format"])
    two = RU.apply_patterns(one.drop("handled"), ["timestamp_format", "type_cast"], value="other")
    return two.select(
        "event_id", got("value", "$.at", "bigint").alias("cast_first"), got("other", "$.at").alias("time_first")
    )


@query(
    "T11",
    """SELECT doc_id, md5(regexp_replace(regexp_replace(text, '\\A[\\t\\n\\x0B\\f\\r ]+', ''), '[\\t\\n\\x0B\\f\\r ]+\\z', '')) AS stripped,
              md5(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS block FROM documents""",
)
def fence_strip(t: Tables):
    """Whole texts inside fences, or bare, give the text back."""
    fenced = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("```json\n"), F.col("text"), F.lit("\n```"))).otherwise(
        F.concat(F.lit("  "), F.col("text"))
    )
    block = F.concat(F.lit("```\n"), F.col("text"), F.lit("\n```"))
    return t.wide("documents").select(
        "doc_id", F.md5(V.strip_fences(fenced)).alias("stripped"), F.md5(V.code_block(block)).alias("block")
    )


@query(
    "T12",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE 2 END AS items,
              CASE WHEN o_orderkey % 4 < 3 THEN o_custkey END AS first_item FROM orders""",
)
def array_extract(t: Tables):
    """The root array, the first array field in written order, or nothing."""
    answer = F.expr(
        """case o_orderkey % 4 when 0 then concat('[', o_custkey, ',1]')
             when 1 then concat('{"z":[', o_custkey, ',2],"a":[0]}')
             when 2 then concat('{"n":1,"rows":[', o_custkey, ',3]}') else '{"n":1}' end"""
    )
    out = t.wide("orders").select("o_orderkey", V.first_json_array(answer).alias("found"))
    return out.select(
        "o_orderkey", F.json_array_length("found").alias("items"), got("found", "$[0]", "bigint").alias("first_item")
    )


@query(
    "T13",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 4 THEN 'http://h/{id}/s/{st}/{gone}'
          ELSE 'http://h/' || o_orderkey || '/s/' || o_orderstatus || '/gone' END AS url FROM orders""",
)
def url_template(t: Tables):
    body = F.expr(
        "case when o_orderkey % 9 = 4 then '{bad' else to_json(named_struct('id', o_orderkey, 'st', o_orderstatus)) end"
    )
    return t.wide("orders").select("o_orderkey", T.render_url("http://h/{id}/s/{st}/{gone}", body).alias("url"))


@query(
    "T14",
    """SELECT o_orderkey, 'orderId (integer), custId (string), orderStatus (string), totalPrice (string), '
         || 'detail (object: level (string), dates (object: placedOn (string))), items (array of code (integer))' AS shape
       FROM orders""",
)
def structure_text(t: Tables):
    return t.orders_json().select(F.col("ordinal").alias("o_orderkey"), V.describe(F.col("value")).alias("shape"))


@query(
    "T15",
    """SELECT o_orderkey, 'Order ' || o_orderkey || ' (' || lower(o_orderstatus) || ')' AS title,
         CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_totalprice > 100000 THEN 'medium' ELSE 'small' END AS size_class,
         round(o_totalprice * 100) AS cents, o_orderkey % 7 + 100 AS first_code, 2 AS code_count, o_orderpriority AS level
       FROM orders""",
)
def sql_transform(t: Tables):
    """Conditions, text building, number parsing, nesting and a mapped array, as expressions per output."""
    out = M.apply_sql_transform(
        t.orders_json(),
        {
            "title": "concat('Order ', try_variant_get(input, '$.orderId', 'string'), ' (', lower(try_variant_get(input, '$.orderStatus', 'string')), ')')",
            "size_class": "case when try_variant_get(input, '$.totalPrice', 'double') > 300000 then 'large' when try_variant_get(input, '$.totalPrice', 'double') > 100000 then 'medium' else 'small' end",
            "cents": "cast(round(try_cast(try_variant_get(input, '$.totalPrice', 'string') as double) * 100) as bigint)",
            "codes": "transform(try_variant_get(input, '$.items', 'array<variant>'), x -> named_struct('label', try_variant_get(x, '$.code', 'bigint') + 100))",
            "nested": "named_struct('level', coalesce(try_variant_get(input, '$.detail.level', 'string'), 'unknown'))",
        },
    )
    return out.select(
        F.col("ordinal").alias("o_orderkey"),
        got("value", "$.title").alias("title"),
        got("value", "$.size_class").alias("size_class"),
        got("value", "$.cents", "double").alias("cents"),
        got("value", "$.codes[0].label", "bigint").alias("first_code"),
        F.json_array_length(F.get_json_object("value", "$.codes")).alias("code_count"),
        got("value", "$.nested.level").alias("level"),
    )


@query(
    "T16",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 7500 THEN 'platinum' WHEN c_acctbal >= 5000 THEN 'gold'
          WHEN c_acctbal >= 0 THEN 'silver' ELSE 'review' END AS tier,
          CAST(round(c_acctbal * 100) AS BIGINT) AS balance_cents,
          c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') AS industrial FROM customer""",
)
def derived_fields(t: Tables):
    return M.derive_columns(
        t.wide("customer"),
        {
            "tier": "case when c_acctbal >= 7500 then 'platinum' when c_acctbal >= 5000 then 'gold' when c_acctbal >= 0 then 'silver' else 'review' end",
            "balance_cents": "cast(round(c_acctbal * 100) as bigint)",
            "industrial": "c_mktsegment in ('AUTOMOBILE', 'MACHINERY')",
        },
    ).select("c_custkey", "tier", "balance_cents", "industrial")


# ------------------------------------------------------------ profile and route

def shaped(t: Tables):
    """Orders whose records differ in width and depth; some are not JSON and some are NULL."""
    return t.wide("orders").selectExpr(
        "o_orderkey ordinal",
        "o_orderkey div 40 batch_id",
        """case o_orderkey % 6
             when 0 then to_json(named_struct('a:b', o_orderkey, 'c{', 'x:"{[', 'd', null, 'e', 1.5D, 'f', '\\\\'))
             when 1 then '[[[[1]]]]'
             when 2 then '"just: text {"'
             when 3 then '{"a":[{"b":1},{"b":2,"c":{"d":[]}}]}'
             when 4 then '{"x": {"y": []}}'
           end value""",
    )


@query(
    "R1, R2",
    """SELECT o_orderkey AS ordinal, CASE o_orderkey % 6 WHEN 0 THEN 4 WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 5 WHEN 4 THEN 2 END AS fields,
              CASE o_orderkey % 6 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 0 WHEN 3 THEN 5 WHEN 4 THEN 3 END AS depth,
              CASE WHEN o_orderkey % 6 < 5 THEN TRUE END AS parseable FROM orders""",
)
def record_profile(t: Tables):
    """Keys and depth are counted on the text outside of literals."""
    return PR.record_profile(shaped(t)).select(
        "ordinal", F.col("fields").cast("bigint").alias("fields"), F.col("depth").cast("bigint").alias("depth"), "parseable"
    )


_ROUTE_SQL = """WITH r AS (SELECT o_orderkey, o_orderkey // 7 AS batch_id,
     CASE (o_orderkey // 7) % 5 WHEN 0 THEN 3 WHEN 1 THEN 7 WHEN 2 THEN 2 WHEN 3 THEN 4
          ELSE CASE WHEN o_orderkey % 7 = 3 THEN NULL ELSE 1 END END AS fields,
     CASE (o_orderkey // 7) % 5 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 4
          ELSE CASE WHEN o_orderkey % 7 = 3 THEN NULL ELSE 1 END END AS depth FROM orders),
   p AS (SELECT batch_id, count(*) AS records, CAST(coalesce(sum(fields), 0) AS BIGINT) AS total_fields,
     coalesce(max(depth), 0) AS max_depth, bool_and(fields IS NOT NULL) AS all_parseable FROM r GROUP BY batch_id),
   q AS (SELECT *, total_fields // records AS avg_fields FROM p)"""
_TIER = """CASE WHEN all_parseable AND avg_fields <= 5 AND max_depth <= 1 THEN {simple}
     WHEN NOT all_parseable OR max_depth > 3 OR avg_fields > 20 THEN 3 ELSE 2 END"""


def routed_input(t: Tables):
    return t.wide("orders").selectExpr(
        "o_orderkey ordinal",
        "o_orderkey div 7 batch_id",
        """case (o_orderkey div 7) % 5
             when 0 then to_json(named_struct('a', o_orderkey, 'b', o_orderstatus, 'c', 1))
             when 1 then to_json(named_struct('a', 1, 'b', 2, 'c', 3, 'd', 4, 'e', 5, 'f', 6, 'g', o_orderkey))
             when 2 then '{"a":{"b":1}}'
             when 3 then '{"a":{"b":{"c":{"d":1}}}}'
             else case when o_orderkey % 7 = 3 then '{broken' else '{"a":1}' end end value""",
    )


@query(
    "R3",
    _ROUTE_SQL + " SELECT batch_id, records, total_fields, avg_fields, max_depth, all_parseable FROM q",
)
def batch_profile(t: Tables):
    return PR.batch_profile(routed_input(t)).select(
        "batch_id", "records", F.col("total_fields").cast("bigint").alias("total_fields"), "avg_fields", "max_depth", "all_parseable"
    )


@query(
    "R4 (per batch)",
    _ROUTE_SQL
    + f""", d AS (SELECT batch_id, {_TIER.format(simple=0)} AS tier FROM q)
     SELECT o_orderkey AS ordinal, tier, CASE tier WHEN 1 THEN 'small' WHEN 2 THEN 'medium' WHEN 3 THEN 'big' END AS model
     FROM r JOIN d USING (batch_id)""",
)
def batch_route(t: Tables):
    out = PR.route(routed_input(t), {1: "small", 2: "medium", 3: "big"}, ("field_rename",))
    return out.select("ordinal", "tier", "model")


@query(
    "R4 (per record)",
    """SELECT o_orderkey AS ordinal, CASE (o_orderkey // 7) % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 2 WHEN 3 THEN 3
         ELSE CASE WHEN o_orderkey % 7 = 3 THEN 3 ELSE 1 END END AS tier FROM orders""",
)
def record_route(t: Tables):
    return PR.route(routed_input(t), {1: "small", 2: "medium", 3: "big"}, granularity="record").select("ordinal", "tier")


_FLAT = """SELECT c_custkey AS ordinal, '{acctBal=' || 'number' || ', custId=integer, custName=string'
     || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ', mktSegment=string' END
     || CASE WHEN c_custkey % 5 = 0 THEN ', note=null' ELSE '' END || '}' AS structure FROM customer"""


@query("R5 (flat)", _FLAT)
def flat_structure(t: Tables):
    return t.flat_json().select("ordinal", V.flat_structure(F.col("value")).alias("structure"))


@query(
    "R5 (any depth)",
    """SELECT o_orderkey AS ordinal, '{custId=string, detail=object, detail.dates=object, detail.dates.placedOn=string, '
         || 'detail.level=string, items=array, items[]=object, items[].code=integer, orderId=integer, '
         || 'orderStatus=string, totalPrice=string}' AS structure FROM orders""",
)
def deep_structure(t: Tables):
    return t.orders_json().select("ordinal", V.exact_structure(F.col("value")).alias("structure"))


@query("R6", f"SELECT ordinal, sha256(structure || '|contract') AS fingerprint FROM ({_FLAT})")
def structure_fingerprint(t: Tables):
    return PR.with_fingerprint(t.flat_json(), "contract", "flat").select("ordinal", "fingerprint")


@query(
    "R7",
    f"""SELECT sha256(structure || '|') AS fingerprint, count(*) AS records, min(ordinal) AS first_seen, max(ordinal) AS last_seen
        FROM ({_FLAT}) GROUP BY 1""",
)
def schema_inventory(t: Tables):
    return PR.schema_inventory(t.flat_json(), "ordinal", mode="flat")


@query(
    "R7 (nested)",
    """SELECT count(DISTINCT k) AS structures, CAST(sum(c) AS BIGINT) AS records, max(c) AS largest FROM
       (SELECT o_orderkey % 3 AS k, count(*) AS c FROM orders GROUP BY 1)""",
)
def nested_inventory(t: Tables):
    """Structures told apart at any depth from the VARIANT schema, without values."""
    records = t.wide("orders").selectExpr(
        "o_orderkey ordinal",
        """case o_orderkey % 3 when 0 then to_json(named_struct('a', named_struct('b', o_totalprice)))
             when 1 then to_json(named_struct('a', named_struct('b', o_orderkey)))
             else to_json(named_struct('a', named_struct('b', array(o_orderstatus)))) end value""",
    )
    # o_totalprice may be whole (1000.0), which is still a number, not an integer
    found = PR.schema_inventory(records, "ordinal", mode="deep")
    return found.agg(
        F.count(F.lit(1)).alias("structures"), F.sum("records").alias("records"), F.max("records").alias("largest")
    )


@query(
    "R8",
    """WITH n AS (SELECT count(*) AS total FROM customer)
       SELECT 'custId' AS field, 'integer' AS kinds, total AS present, TRUE AS required, FALSE AS nullable, CAST(NULL AS VARCHAR) AS small_set FROM n
       UNION ALL SELECT 'custName', 'string', total, TRUE, FALSE, NULL FROM n
       UNION ALL SELECT 'acctBal', 'number', total, TRUE, FALSE, NULL FROM n
       UNION ALL SELECT 'mktSegment', 'string', (SELECT count(*) FROM customer WHERE c_custkey % 3 <> 0), FALSE, FALSE,
            (SELECT string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) FROM customer WHERE c_custkey % 3 <> 0)
       UNION ALL SELECT 'note', '', (SELECT count(*) FROM customer WHERE c_custkey % 5 = 0), FALSE, TRUE, NULL""",
)
def discovered_fields(t: Tables):
    return PR.discover_fields(t.flat_json()).select(
        "field",
        F.array_join("kinds", ",").alias("kinds"),
        "present",
        "required",
        "nullable",
        F.array_join("values", ",").alias("small_set"),
    )


def _paths(table: str, rows: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{table}' AS source, '{p}' AS path, '{k}' AS kind, {n} AS occurrences FROM {table}" for p, k, n in rows)


_N = "count(*)"
_EVENT_PATHS = [
    ("$", "object", _N), ("$.id", "integer", _N), ("$.who", "object", _N), ("$.who.user", "integer", _N), ("$.who.seen", "array", _N),
    ("$.who.seen[]", "object", _N), ("$.who.seen[].type", "string", _N), ("$.who.seen[].value", "number", _N), ("$.props", "object", _N),
    ("$.props.k", "integer", _N), ("$.by", "object", _N), ("$.by.*", "object", _N), ("$.by.*.n", "integer", _N),
]
_DOCUMENT_PATHS = [
    ("$", "object", _N), ("$.doc", "object", _N), ("$.doc.id", "integer", _N), ("$.doc.meta", "object", _N), ("$.doc.meta.lang", "string", "count(lang)"),
    ("$.doc.meta.source", "string", "count(source)"), ("$.doc.meta.size", "object", _N), ("$.doc.meta.size.chars", "integer", "count(n_chars)"),
    ("$.doc.text", "string", "count(text)"),
]
_TURN_PATHS = [
    ("$", "object", _N), ("$.conv", "integer", _N), ("$.turn", "object", _N), ("$.turn.no", "integer", _N), ("$.turn.said", "object", _N),
    ("$.turn.said.role", "string", "count(role)"), ("$.turn.said.words", "array", _N), ("$.turn.said.words[]", "string", "2 * count(*)"),
]


@query("R8 (nested)", " UNION ALL ".join([_paths("events", _EVENT_PATHS), _paths("documents", _DOCUMENT_PATHS), _paths("conversations", _TURN_PATHS)]))
def discovered_paths(t: Tables):
    """Every path of records nested four deep, with its kinds; user ids used as keys are one path."""
    records = {
        "events": t("events").selectExpr(
            """concat('{"id":', event_id, ',"props":', props, ',"who":', to_json(named_struct('user', user_id, 'seen', array(named_struct('type', event_type, 'value', value)))),
                      ',"by":{"u', user_id, '":{"n":1}}}') value"""
        ),
        "documents": t("documents").selectExpr(
            "to_json(named_struct('doc', named_struct('id', doc_id, 'text', text, 'meta', named_struct('lang', lang, 'source', source, 'size', named_struct('chars', n_chars))))) value"
        ),
        "conversations": t("conversations").selectExpr(
            "to_json(named_struct('conv', conv_id, 'turn', named_struct('no', turn, 'said', named_struct('role', role, 'words', array('a', coalesce(text, '')))))) value"
        ),
    }
    found = [
        D.discover_paths(rows).select(F.lit(name).alias("source"), "path", "kind", "occurrences") for name, rows in records.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    "B1 with R3 (batches of consecutive records)",
    """SELECT batch_id, count(*) AS records, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM
       (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 64 AS batch_id FROM orders)
       GROUP BY batch_id""",
)
def batch_ranges(t: Tables):
    out = B.assign_batches(t.wide("orders").select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], 64)
    return out.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("records"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )
