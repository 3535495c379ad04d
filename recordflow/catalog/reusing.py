"""Queries for reuse: similarity cache, exact reuse, compiled mappings."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..functions import variant as V
from ..operators import contract as C
from ..operators import profiling as PR
from ..operators import records as R
from ..operators import reuse as U
from ..operators.staging import compute_once
from .base import Tables, got, query

_START = "2024-06-01 00:00:00"


def vector_cache(t: Tables):
    """Every vector with vec_id % 3 = 0 is a stored entry; entries age with their id."""
    return t("embeddings").filter("vec_id % 3 = 0").selectExpr(
        "vec_id cache_id",
        "embedding",
        "concat('out-', vec_id) output",
        f"timestamp'{_START}' - make_dt_interval(0, 0, 0, vec_id) created_at",
    )


def _nearest_sql(threshold: float, ttl: int | None) -> str:
    alive = f"AND vec_id < {ttl}" if ttl is not None else ""
    return f"""WITH u AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
      s AS (SELECT q.vec_id AS query_id, c.vec_id AS cache_id,
               list_cosine_similarity(q.e, c.e) AS sim
            FROM u q, u c WHERE c.vec_id % 3 = 0 {alive.replace('vec_id', 'c.vec_id')}),
      b AS (SELECT query_id, cache_id, sim, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, cache_id) AS rn FROM s),
      h AS (SELECT * FROM b WHERE rn = 1 AND sim >= {threshold})
      SELECT u.vec_id AS query_id, h.cache_id IS NOT NULL AS hit, h.cache_id AS cache_id, 'out-' || h.cache_id AS output,
             round(h.sim, 5) AS similarity, h.cache_id AS age_seconds FROM u LEFT JOIN h ON u.vec_id = h.query_id"""


def _lookup(t: Tables, threshold: float, ttl: int | None):
    queries = t("embeddings").selectExpr("vec_id query_id", "embedding")
    now = F.expr(f"timestamp'{_START}'")
    return U.cache_lookup(queries, vector_cache(t), threshold, ttl, now).select(
        "query_id", "hit", "cache_id", "output", F.round("similarity", 5).alias("similarity"), "age_seconds"
    )


@query("C1", _nearest_sql(0.6, None))
def nearest_entry(t: Tables):
    return _lookup(t, 0.6, None)


@query("C1 (high threshold), C2", _nearest_sql(0.95, 200))
def nearest_live_entry(t: Tables):
    return _lookup(t, 0.95, 200)


@query(
    "C2",
    """SELECT vec_id AS cache_id, 'out-' || vec_id AS output FROM embeddings WHERE vec_id % 3 = 0 AND vec_id < 240""",
)
def live_cache_entries(t: Tables):
    return U.live_entries(vector_cache(t), 240, F.expr(f"timestamp'{_START}'")).select("cache_id", "output")


@query(
    "C3",
    """SELECT source, count(*) FILTER (quality = 1) AS hits, count(*) AS lookups,
              round(count(*) FILTER (quality = 1) * 1.0 / count(*), 6) AS hit_ratio
       FROM documents JOIN labels USING (doc_id) GROUP BY source""",
)
def cache_ratio(t: Tables):
    from ..operators.accounting import cache_hit_ratio

    log = t("documents").select("doc_id", "source").join(t("labels"), "doc_id").withColumn("hit", F.col("quality") == 1)
    return cache_hit_ratio(log, by=["source"]).withColumn("hit_ratio", F.round("hit_ratio", 6))


@query(
    "C4",
    """WITH c AS (SELECT text, max(doc_id) AS newest FROM documents WHERE doc_id % 2 = 0 GROUP BY text)
       SELECT doc_id, c.newest IS NOT NULL AS hit, 'done-' || c.newest AS output FROM documents LEFT JOIN c USING (text)""",
)
def exact_reuse(t: Tables):
    """Whole texts against stored results of half of them; the newest result of equal texts counts."""
    docs = t("documents").select("doc_id", F.col("text").alias("value"))
    stored = docs.filter("doc_id % 2 = 0").select(
        U.content_key(F.col("value")).alias("content_key"),
        F.concat(F.lit("done-"), F.col("doc_id").cast("string")).alias("output"),
        F.col("doc_id").alias("created_at"),
    )
    return U.exact_reuse(docs, stored).select("doc_id", "hit", "output")


@query(
    "C4 (work left after merging equal texts)",
    "SELECT sha256(text) AS content_key, min(doc_id) AS first_ordinal, count(*) AS uses FROM documents GROUP BY text",
)
def distinct_work(t: Tables):
    return U.distinct_work(t("documents"), "text", "doc_id")


# ------------------------------------------------------------ compiled specs

CUSTOMER_CONTRACT = C.Contract.parse(
    {"properties": {"id": {"type": "integer"}, "segment": {"type": "string"}}, "required": ["id", "segment"]}
)


def customer_records(t: Tables):
    return PR.with_fingerprint(t.flat_json(), CUSTOMER_CONTRACT.text, "flat")


def spec_log(t: Tables):
    """Specs as stored over time: one structure gets a good mapping, one a mapping that fails, one an expression."""
    a = {"mappings": {"id": "$.custId", "segment": "$.mktSegment"}}
    b = {"mappings": {"id": "$.custId", "segment": "$.acctBal"}}
    c = {"id": "try_variant_get(input, '$.custId', 'bigint')", "segment": "concat('none/', try_variant_get(input, '$.custName', 'string'))"}
    flat = lambda *parts: "{" + ", ".join(["acctBal=number", "custId=integer", "custName=string", *parts]) + "}"
    rows = [
        (flat("mktSegment=string"), "DECLARATIVE", json.dumps(b), 1),
        (flat("mktSegment=string"), "DECLARATIVE", json.dumps(a), 2),
        (flat("mktSegment=string", "note=null"), "DECLARATIVE", json.dumps(b), 2),
        (flat(), "SQL_EXPR", json.dumps(c), 2),
    ]
    return t.spark.createDataFrame(rows, "structure string, type string, code string, day int").select(
        V.fingerprint_of(F.col("structure"), CUSTOMER_CONTRACT.text).alias("fingerprint"),
        "type",
        "code",
        F.expr("timestamp'2024-01-01' + make_dt_interval(day)").alias("created_at"),
        F.lit("m").alias("model"),
    )


@query(
    "K1, K2",
    """SELECT c_custkey AS ordinal,
         CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 5 <> 0 THEN 'done' WHEN c_custkey % 3 = 0 AND c_custkey % 5 <> 0 THEN 'done' ELSE 'rest' END AS went,
         CASE WHEN c_custkey % 5 <> 0 THEN c_custkey END AS id,
         CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 3 <> 0 THEN c_mktsegment ELSE 'none/' || c_name END AS segment
       FROM customer""",
)
def compiled_records(t: Tables):
    """A known structure is mapped; a spec that breaks the contract sends its whole structure on."""
    done, rest, _ = U.apply_compiled(customer_records(t), U.live_specs(spec_log(t)), CUSTOMER_CONTRACT)
    both = done.withColumn("went", F.lit("done")).unionByName(rest.withColumn("went", F.lit("rest")))
    mapped = F.col("went") == "done"
    return both.select(
        "ordinal",
        "went",
        F.when(mapped, got("value", "$.id", "bigint")).alias("id"),
        F.when(mapped, got("value", "$.segment")).alias("segment"),
    )


@query(
    "K2 (invalid specs)",
    """SELECT count(*) AS failed FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 3 <> 0""",
)
def invalid_specs(t: Tables):
    _, _, invalid = U.apply_compiled(customer_records(t), U.live_specs(spec_log(t)), CUSTOMER_CONTRACT)
    return invalid.select("failed")


@query(
    "K1 (many structures, specs applied as data)",
    """SELECT o_orderkey, o_orderkey % 97 AS spec_no, o_custkey AS out_value, 'd' AS kind FROM orders""",
)
def many_specs(t: Tables):
    """97 structures, more than are unrolled into the plan: the mapping is then read from the spec table."""
    def body(number: str, inner: str) -> str:
        return """concat('{"field', """ + number + """, '":{"v":"', """ + inner + """, '"}}') value"""

    records = t.wide("orders").selectExpr("o_orderkey", body("o_orderkey % 97", "o_custkey"))
    marked = PR.with_fingerprint(records, "", "deep")
    shapes = PR.with_fingerprint(t.spark.range(97).selectExpr("id n", body("id", "0")), "", "deep")
    specs = shapes.select(
        "fingerprint",
        F.lit("DECLARATIVE").alias("type"),
        F.expr(
            """concat('{"mappings":{"out":"$.field', n, '.v"},"defaults":{"kind":"d"},"typeCasts":{"out":"integer"}}')"""
        ).alias("code"),
        F.expr("timestamp'2024-01-01'").alias("created_at"),
        F.lit("m").alias("model"),
    )
    done, _, _ = U.apply_compiled(marked, specs, C.Contract.parse({"properties": {"out": {"type": "integer"}}}))
    return done.select(
        "o_orderkey",
        (F.col("o_orderkey") % 97).alias("spec_no"),
        got("value", "$.out", "bigint").alias("out_value"),
        got("value", "$.kind").alias("kind"),
    )


@query(
    "K1 (many structures, SQL specs in groups)",
    """SELECT o_orderkey, o_custkey + o_orderkey % 400 AS out_value, CASE WHEN o_orderkey % 400 < 200 THEN 'sql' ELSE 'd' END AS kind FROM orders""",
)
def many_sql_specs(t: Tables):
    """200 structures under SQL specs, more than one plan takes, and 200 under mappings."""
    def body(number: str, inner: str) -> str:
        return f"""concat('{{"field', {number}, '":{{"v":"', {inner}, '"}}}}') value"""

    shown = "o_custkey + if(o_orderkey % 400 < 200, 0, o_orderkey % 400)"
    records = t.wide("orders").selectExpr("o_orderkey", body("o_orderkey % 400", shown))
    marked = PR.with_fingerprint(records, "", "deep")
    shapes = PR.with_fingerprint(t.spark.range(400).selectExpr("id n", body("id", "0")), "", "deep")
    quoted = """'{"out":"try_variant_get(input, \\'$.field', n, '.v\\', \\'bigint\\') + ', n, '","kind":"\\'sql\\'"}'"""
    mapping = """'{"mappings":{"out":"$.field', n, '.v"},"defaults":{"kind":"d"},"typeCasts":{"out":"integer"}}'"""
    specs = shapes.select(
        "fingerprint",
        F.expr("if(n < 200, 'SQL_EXPR', 'DECLARATIVE')").alias("type"),
        F.expr(f"if(n < 200, concat({quoted}), concat({mapping}))").alias("code"),
        F.expr("timestamp'2024-01-01'").alias("created_at"),
        F.lit("m").alias("model"),
    )
    done, _, _ = U.apply_compiled(marked, specs, C.Contract.parse({"properties": {"out": {"type": "integer"}}}))
    return done.select("o_orderkey", got("value", "$.out", "bigint").alias("out_value"), got("value", "$.kind").alias("kind"))


@query(
    "K3",
    """WITH p AS (SELECT user_id, event_id, ts, event_type,
               row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type <> 'error'),
            i AS (SELECT user_id, max(ts) AS dropped FROM events WHERE event_type = 'error' GROUP BY 1)
       SELECT CAST(p.user_id AS VARCHAR) AS fingerprint, 'code-' || p.event_id AS code FROM p LEFT JOIN i USING (user_id)
       WHERE rn = 1 AND (i.dropped IS NULL OR i.dropped < p.ts) AND p.ts >= TIMESTAMP '2024-01-29 00:00:00'""",
)
def live_specs(t: Tables):
    """Events as a spec log: the last put per key, not older than the limit and not invalidated since."""
    puts = t("events").filter("event_type <> 'error'").selectExpr(
        "cast(user_id as string) fingerprint",
        "'DECLARATIVE' type",
        "concat('code-', event_id) code",
        "cast(ts as timestamp) created_at",
        "'m' model",
    )
    drops = t("events").filter("event_type = 'error'").selectExpr(
        "cast(user_id as string) fingerprint", "cast(ts as timestamp) invalidated_at"
    )
    now = F.expr("timestamp'2024-01-30'")
    return U.live_specs(puts, 86400, now, drops).select("fingerprint", "code")


class PathClient:
    """Proposes the mapping for structures with a segment, a failing one for the others, then an expression."""

    def call(self, request: dict) -> dict:
        text = request["user_prompt"]
        if "SQL expression" in text:
            code = {"id": "try_variant_get(input, '$.custId', 'bigint')", "segment": "'none'"}
        elif "mktSegment (string)" in text:
            code = {"mappings": {"id": "$.custId", "segment": "$.mktSegment"}}
        else:
            return {"content": "NEEDS_SQL", "model": "fake"}
        return {"content": "```json\n" + json.dumps(code) + "\n```", "model": "fake", "input_tokens": len(text) // 4}


@query(
    "K4",
    """SELECT CASE WHEN c_custkey % 3 = 0 THEN 'SQL_EXPR' ELSE 'DECLARATIVE' END AS type, count(DISTINCT c_custkey % 5 = 0) AS specs
       FROM customer GROUP BY 1""",
)
def compiled_on_demand(t: Tables):
    """One spec per structure: a mapping where it passes on the samples, else an expression."""
    specs = U.compile_specs(customer_records(t), PathClient(), CUSTOMER_CONTRACT, "ordinal", wait_seconds=0.0)
    return specs.groupBy("type").agg(F.count(F.lit(1)).alias("specs"))


@query(
    "K4 then K1",
    """SELECT c_custkey AS ordinal, c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'none' ELSE c_mktsegment END AS segment FROM customer""",
)
def compiled_then_applied(t: Tables):
    rows = customer_records(t)
    specs = U.compile_specs(rows, PathClient(), CUSTOMER_CONTRACT, "ordinal", wait_seconds=0.0)
    done, _, _ = U.apply_compiled(rows, specs, CUSTOMER_CONTRACT)
    return done.select(
        "ordinal", got("value", "$.id", "bigint").alias("id"), got("value", "$.segment").alias("segment")
    )


@query(
    "K5",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE o_custkey END AS a,
         o_orderkey % 4 IN (1, 3) AS still_wrapped FROM orders""",
)
def sample_unwrap(t: Tables):
    """Wrapped records are opened when the wrapper is small and its value is JSON."""
    records = t.wide("orders").selectExpr(
        "o_orderkey",
        """case o_orderkey % 4
             when 0 then to_json(named_struct('key', 'k', 'value', concat('{"a":', o_custkey, '}')))
             when 1 then to_json(named_struct('a', o_custkey, 'key', 'k', 'value', '{}', 'x', 1))
             when 2 then concat('{"a":', o_custkey, '}')
             else '{"key":"k","value":"not json {"}' end value""",
    )
    out = compute_once(R.unwrap_samples(records), {"v": V.parse(F.col("value"))})
    return out.select(
        "o_orderkey",
        F.try_variant_get("v", "$.a", "bigint").alias("a"),
        F.try_variant_get("v", "$.value", "string").isNotNull().alias("still_wrapped"),
    )
