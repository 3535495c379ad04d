"""Queries for reads: incremental tables, change feeds, shards, topics, paged sources, record shapes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import paging as P
from ..operators import changes as CH
from ..operators import records as R
from ..sources import incremental as I
from ..sources.crawl import crawl
from .base import Tables, day, got, query


@query("S1", "SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_day FROM orders")
def bulk_read(t: Tables):
    return I.read_incremental(t("orders"), "bulk").select(
        "o_orderkey", "o_custkey", "o_totalprice", day("o_orderdate", "yyyy-MM-dd").alias("o_day")
    )


@query(
    "S2",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events
       WHERE ts > TIMESTAMP '2024-01-10 00:00:00'""",
)
def timestamp_incremental(t: Tables):
    df = I.read_incremental(t("events"), "timestamp", ts_col="ts", offset={"ts": _ntz("2024-01-10 00:00:00")})
    return df.select("event_id", day("ts").alias("ts_text"))


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query("S3", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 4999")
def id_incremental(t: Tables):
    df = I.read_incremental(t("orders"), "incrementing", id_col="o_orderkey", offset={"id": 4999})
    return df.select("o_orderkey", "o_totalprice")


_GAPLESS = """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_day FROM orders
    WHERE o_orderdate > TIMESTAMP '1997-03-01' OR (o_orderdate = TIMESTAMP '1997-03-01' AND o_orderkey > 700)"""


@query("S4", _GAPLESS)
def gapless_incremental(t: Tables):
    df = I.read_incremental(
        t("orders"),
        "timestamp+incrementing",
        ts_col="o_orderdate",
        id_col="o_orderkey",
        offset={"ts": _ntz("1997-03-01 00:00:00"), "id": 700},
        ordered=False,
    )
    return df.select("o_orderkey", day("o_orderdate", "yyyy-MM-dd").alias("o_day"))


@query("S4 (page limit)", _GAPLESS + " ORDER BY o_orderdate, o_orderkey LIMIT 500")
def gapless_page(t: Tables):
    df = I.read_incremental(
        t("orders"),
        "timestamp+incrementing",
        ts_col="o_orderdate",
        id_col="o_orderkey",
        offset={"ts": _ntz("1997-03-01 00:00:00"), "id": 700},
        limit=500,
    )
    return df.select("o_orderkey", day("o_orderdate", "yyyy-MM-dd").alias("o_day"))


@query(
    "S5",
    """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, event_id AS id FROM events
       ORDER BY ts DESC, event_id DESC LIMIT 1""",
)
def resume_offset(t: Tables):
    return I.next_offset(t("events"), "timestamp+incrementing", "ts", "event_id").select(
        day("ts").alias("ts_text"), "id"
    )


@query(
    "S7",
    """SELECT 'customer' AS source_table, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier""",
)
def many_tables(t: Tables):
    return R.read_many(
        {
            "customer": t("customer").selectExpr("c_custkey id", "c_name name", "c_mktsegment segment"),
            "supplier": t("supplier").selectExpr("s_suppkey id", "s_name name"),
        }
    ).select("source_table", "id", "name", "segment")


@query(
    "S8",
    """SELECT CAST(o_orderkey AS VARCHAR) AS key, 'orders' AS source_table, o_totalprice AS price,
              NULLIF(o_orderstatus, 'P') AS status, 3 AS fields FROM orders""",
)
def row_envelope(t: Tables):
    rows = t("orders").selectExpr("o_orderkey", "o_totalprice price", "nullif(o_orderstatus, 'P') status")
    return R.to_envelope(rows, ["o_orderkey"], {"source.table": "orders"}).select(
        "key",
        F.col("metadata")["source.table"].alias("source_table"),
        got("value", "$.price", "double").alias("price"),
        got("value", "$.status").alias("status"),
        F.size(F.json_object_keys("value")).alias("fields"),
    )


@query(
    "S9",
    """SELECT o_custkey, o_orderkey, CAST(o_orderkey AS VARCHAR) AS key,
              strftime(max(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '%Y-%m-%d') AS offset_day
       FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-01'""",
)
def watermark_poll(t: Tables):
    df = I.poll_watermark(
        t("orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        "o_orderdate",
        ["o_custkey"],
        _ntz("1996-01-01 00:00:00"),
        arrival=["o_orderkey"],
    )
    return df.select("o_custkey", "o_orderkey", "key", day("offset_ts", "yyyy-MM-dd").alias("offset_day"))


@query(
    "S10",
    """SELECT lower(lpad(printf('%x', event_id), 24, '0')) AS object_id, event_type FROM events
       WHERE event_id > 4096""",
)
def object_id_poll(t: Tables):
    df = t("events").select(F.lower(F.lpad(F.hex("event_id"), 24, "0")).alias("object_id"), "event_type")
    return I.read_incremental(df, "incrementing", id_col="object_id", offset={"id": f"{4096:024x}"})


@query(
    "S11",
    """SELECT event_id, event_type AS kind, value AS amount FROM events
       WHERE event_type <> 'error' AND value > 5""",
)
def change_feed_read(t: Tables):
    feed = t("events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.to_json(F.struct(F.col("event_type").alias("kind"), "value"))).alias("after"),
    )
    return CH.read_changes(
        feed,
        [
            lambda df: df.filter(got("after", "$.value", "double") > 5),
            lambda df: df.select(
                "event_id", got("after", "$.kind").alias("kind"), got("after", "$.value", "double").alias("amount")
            ),
        ],
    )


def change_events(t: Tables):
    """Events as typed change records: every fourth inserts, every fourth removes, the others modify."""

    def item(scale: str) -> str:
        return (
            "named_struct('id', named_struct('N', cast(user_id as string)), "
            "'kind', named_struct('S', event_type), "
            f"'amount', named_struct('N', cast(value * {scale} as string)), "
            "'big', named_struct('BOOL', value > 50), 'none', named_struct('NUL', true))"
        )

    return t.wide("events").selectExpr(
        "event_id",
        f"""to_json(named_struct(
              'eventName', case event_id % 4 when 0 then 'INSERT' when 1 then 'REMOVE' else 'MODIFY' end,
              'newImage', case when event_id % 4 <> 1 then {item('1')} end,
              'oldImage', case when event_id % 4 <> 0 then {item('2')} end,
              'keys', named_struct('id', named_struct('N', cast(user_id as string))))) value""",
    )


@query(
    "S12",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'delete' ELSE 'update' END AS op,
         user_id AS key_id,
         CASE WHEN event_id % 4 <> 1 THEN round(value, 4) END AS new_amount,
         CASE WHEN event_id % 4 <> 0 THEN round(value * 2, 4) END AS old_amount,
         CASE WHEN event_id % 4 <> 1 THEN event_type END AS new_kind,
         CASE WHEN event_id % 4 <> 1 THEN value > 50 END AS big,
         CASE WHEN event_id % 4 <> 1 THEN 5 END AS new_fields
       FROM events""",
)
def change_decode(t: Tables):
    return CH.decode_change_events(change_events(t)).select(
        "event_id",
        "op",
        got("key", "$.id", "bigint").alias("key_id"),
        F.round(got("after", "$.amount", "double"), 4).alias("new_amount"),
        F.round(got("before", "$.amount", "double"), 4).alias("old_amount"),
        got("after", "$.kind").alias("new_kind"),
        got("after", "$.big", "boolean").alias("big"),
        F.size(F.json_object_keys("after")).alias("new_fields"),
    )


@query(
    "S13 (batch form)",
    """WITH e AS (SELECT 'shard-' || (user_id % 6) AS shard, event_id AS seq, event_type FROM events),
            o AS (SELECT shard, max(seq) // 2 AS last_seq FROM e WHERE shard <> 'shard-5' GROUP BY shard)
       SELECT e.shard, e.seq, e.event_type FROM e LEFT JOIN o USING (shard)
       WHERE o.last_seq IS NULL OR e.seq > o.last_seq""",
)
def shard_resume(t: Tables):
    log = t("events").selectExpr("concat('shard-', user_id % 6) shard", "event_id seq", "event_type")
    offsets = log.filter("shard <> 'shard-5'").groupBy("shard").agg(F.expr("max(seq) div 2").alias("last_seq"))
    return I.shards_since(log, offsets).select("shard", "seq", "event_type")


@query(
    "S13 (positions)",
    """SELECT 'shard-' || (user_id % 6) AS shard, max(event_id) AS last_seq FROM events GROUP BY 1
       UNION ALL SELECT 'shard-closed', 41""",
)
def shard_positions(t: Tables):
    log = t("events").selectExpr("concat('shard-', user_id % 6) shard", "event_id seq")
    stored = t.spark.sql("select 'shard-closed' shard, 41L last_seq")
    return I.shard_positions(log, stored)


@query(
    "S14 (record form)",
    """SELECT CAST(user_id AS VARCHAR) AS key, event_type, 'events' AS topic, CAST(user_id % 4 AS VARCHAR) AS part,
              CAST(event_id AS VARCHAR) AS off FROM events""",
)
def topic_records(t: Tables):
    topic = t("events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct("event_type", "value")).cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return R.topic_envelope(topic).select(
        "key",
        got("value", "$.event_type").alias("event_type"),
        F.col("metadata")["source.topic"].alias("topic"),
        F.col("src_partition")["partition"].alias("part"),
        F.col("src_offset")["offset"].alias("off"),
    )


BLOCK, PAGE = 64, 16


def order_pages(t: Tables):
    """Orders by block of 64 keys as response bodies of 16 keys each, with a cursor to the next page there is."""
    pages = (
        t("orders")
        .selectExpr(f"o_orderkey div {BLOCK} block", f"(o_orderkey % {BLOCK}) div {PAGE} page_no", "o_orderkey", "o_totalprice")
        .groupBy("block", "page_no")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price")))).alias("rows"))
    )
    by_block = Window.partitionBy("block").orderBy("page_no")
    chained = pages.withColumns(
        {"next": F.lead("page_no").over(by_block), "first": F.row_number().over(by_block) == 1}
    )
    return chained.select(
        F.concat(
            F.lit("http://shop.example/orders?block="),
            F.col("block").cast("string"),
            F.when(F.col("first"), F.lit("")).otherwise(F.concat(F.lit("&cursor="), F.col("page_no").cast("string"))),
        ).alias("url"),
        "block",
        "page_no",
        F.to_json(
            F.struct(F.struct(F.col("rows").alias("list")).alias("result"), F.col("next").cast("string").alias("next_cursor"))
        ).alias("body"),
    )


@query(
    "S16",
    """SELECT o_orderkey // 64 AS block, (o_orderkey % 64) // 16 AS page_no, o_orderkey AS order_id, FALSE AS whole_body
       FROM orders WHERE (o_orderkey // 64) % 10 <> 3
       UNION ALL SELECT DISTINCT o_orderkey // 64, (o_orderkey % 64) // 16, CAST(NULL AS BIGINT), TRUE
       FROM orders WHERE (o_orderkey // 64) % 10 = 3""",
)
def page_records(t: Tables):
    """Every tenth block's bodies are cut short, hence not JSON, and come out as whole records."""
    pages = order_pages(t).withColumn(
        "body", F.when(F.col("block") % 10 == 3, F.expr("left(body, length(body) - 1)")).otherwise(F.col("body"))
    )
    return R.extract_records(pages, "result.list").select(
        "block",
        "page_no",
        got("value", "$.id", "bigint").alias("order_id"),
        F.try_parse_json("value").isNull().alias("whole_body"),
    )


_SPLIT_URL = """SELECT page_id, url, regexp_replace(url, '[?#].*$', '') AS base,
       regexp_extract(regexp_replace(url, '#.*$', ''), '\\?(.*)$', 1) AS q FROM pages"""


@query(
    "S17",
    f"""WITH u AS ({_SPLIT_URL})
        SELECT page_id, CASE WHEN page_id % 4 = 3 OR page_id % 4 = 2 THEN NULL ELSE base || '?' ||
           CASE WHEN q = '' THEN 'page=c%26' || page_id
                WHEN regexp_matches(q, '(^|&)page=') THEN regexp_replace(q, '(^|&)page=[^&]*', '\\1page=c%26' || page_id)
                ELSE q || '&page=c%26' || page_id END END AS next_url FROM u""",
)
def cursor_next_url(t: Tables):
    body = F.when(F.col("page_id") % 4 == 3, F.lit('{"meta":{"next":null}}')).when(
        F.col("page_id") % 4 == 2, F.lit('{"meta":{"next":""}}')
    ).otherwise(F.concat(F.lit('{"meta":{"next":"c&'), F.col("page_id").cast("string"), F.lit('"}}')))
    return t("pages").select(
        "page_id",
        P.next_page_url("cursor", F.col("url"), body, cursor_field="meta.next", cursor_param="page").alias("next_url"),
    )


def _sized_body():
    """A page body holding page_id % 5 items, as a root list, a known wrapper or another field."""
    items = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: i)
    some = F.to_json(F.slice(items, F.lit(1), (F.col("page_id") % 5).cast("int")))
    return (
        F.when(F.col("page_id") % 3 == 0, some)
        .when(F.col("page_id") % 3 == 1, F.concat(F.lit('{"other":[1,2,3,4,5,6],"items":'), some, F.lit("}")))
        .otherwise(F.concat(F.lit('{"n":1,"rows":'), some, F.lit(',"more":[7,7,7,7,7]}')))
    )


@query(
    "S18",
    f"""WITH u AS ({_SPLIT_URL}),
        k AS (SELECT page_id, base, q, list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(page|limit)=')) AS kept,
                     coalesce(TRY_CAST(NULLIF(regexp_extract(q, '(?:^|&)page=([^&]*)', 1), '') AS BIGINT), 0) AS pos FROM u)
        SELECT page_id, CASE WHEN page_id % 5 >= 3 THEN base || '?' ||
             CASE WHEN len(kept) > 0 THEN array_to_string(kept, '&') || '&' ELSE '' END
             || 'page=' || (pos + 3) || '&limit=3' END AS next_url FROM k""",
)
def offset_next_url(t: Tables):
    return t("pages").select(
        "page_id",
        P.next_page_url("offset", F.col("url"), _sized_body(), offset_param="page", limit=3).alias("next_url"),
    )


@query(
    "S19",
    f"""WITH u AS ({_SPLIT_URL}),
        k AS (SELECT page_id, base, list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT starts_with(x, 'page=')) AS kept,
                     coalesce(TRY_CAST(NULLIF(regexp_extract(q, '(?:^|&)page=([^&]*)', 1), '') AS BIGINT), 1) AS pos FROM u)
        SELECT page_id, CASE WHEN page_id % 5 > 0 THEN base || '?' ||
             CASE WHEN len(kept) > 0 THEN array_to_string(kept, '&') || '&' ELSE '' END
             || 'page=' || (pos + 1) END AS next_url FROM k""",
)
def page_next_url(t: Tables):
    return t("pages").select(
        "page_id", P.next_page_url("page", F.col("url"), _sized_body()).alias("next_url")
    )


@query(
    "S20",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN url || '/n' END AS next_url FROM pages""",
)
def link_next_url(t: Tables):
    url = F.col("url")
    header = (
        F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("<"), url, F.lit('>; rel="next", <http://x.example/9>; rel="last"')))
        .when(F.col("page_id") % 4 == 1, F.concat(F.lit('<http://x.example/0>; rel="prev", <'), url, F.lit("/n> ;REL = next")))
        .when(F.col("page_id") % 4 == 2, F.concat(F.lit("<"), url, F.lit('>; rel="prev"')))
    )
    return t("pages").select("page_id", P.next_page_url("link", url, headers=header).alias("next_url"))


@query(
    "S21",
    """SELECT 'http://shop.example/orders?block=' || (o_orderkey // 64) AS seed, (o_orderkey % 64) // 16 AS round,
              o_orderkey AS order_id, o_totalprice AS price FROM orders""",
)
def paged_crawl(t: Tables):
    """All pages of all blocks, following cursors; the landed responses stand in for the server."""
    landed = order_pages(t).select(
        "url", "body", F.lit(200).alias("status"), F.lit(None).cast("string").alias("link")
    )
    seeds = t("orders").select(
        F.concat(F.lit("http://shop.example/orders?block="), F.expr(f"cast(o_orderkey div {BLOCK} as string)")).alias("url")
    )
    records = crawl(seeds, lambda frontier: frontier.join(landed, "url"), "cursor", "result.list")
    return records.select(
        "seed",
        F.col("round").cast("bigint").alias("round"),
        got("value", "$.id", "bigint").alias("order_id"),
        got("value", "$.price", "double").alias("price"),
    )


@query(
    "S22",
    """SELECT 'cn=' || (o_orderkey // 16) AS key, count(*) AS orders, count(*) = 1 AS is_scalar,
              min(o_orderkey) AS first_order, 'block' AS kind
       FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01' GROUP BY 1""",
)
def directory_entries(t: Tables):
    """Orders as values of a multi-valued attribute of an entry per 16 keys, read from a mark on, inclusive."""
    rows = t("orders").selectExpr("concat('cn=', o_orderkey div 16) dn", "o_orderkey", "o_orderdate", "cast(o_orderkey as string) entry")
    recent = R.entries_since(rows, "o_orderdate", _ntz("1998-06-01 00:00:00"))
    values = recent.selectExpr("dn", "'order' attribute", "lpad(cast(o_orderkey as string), 12, '0') value").unionByName(
        recent.selectExpr("dn", "'kind' attribute", "'block' value").distinct()
    )
    entries = R.entries_to_records(values)
    many = F.try_variant_get(F.try_parse_json("value"), "$.order", "array<string>")
    one = got("value", "$.order")
    return entries.select(
        "key",
        F.coalesce(F.size(many), F.lit(1)).cast("bigint").alias("orders"),
        many.isNull().alias("is_scalar"),
        F.coalesce(F.get(many, 0), one).cast("bigint").alias("first_order"),
        got("value", "$.kind").alias("kind"),
    )


@query(
    "S23",
    """SELECT user_id AS call_id, 'events' AS table_name, event_id AS row_no, event_type AS kind, CAST(NULL AS VARCHAR) AS name
       FROM events WHERE user_id % 3 <> 0
       UNION ALL SELECT c_custkey, NULL, NULL, NULL, c_name FROM customer
       WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id % 3 <> 0)""",
)
def result_rows_or_params(t: Tables):
    cells = t("events").filter("user_id % 3 <> 0").selectExpr(
        "user_id call_id",
        "'events' table_name",
        "event_id row_no",
        "stack(2, 'kind', event_type, 'value', cast(value as string)) as (name, value)",
    )
    params = t("customer").selectExpr(
        "c_custkey call_id", "stack(2, 'name', c_name, 'segment', c_mktsegment) as (name, value)"
    )
    return R.result_tables_or_params(cells, params).select(
        "call_id", "table_name", "row_no", got("value", "$.kind").alias("kind"), got("value", "$.name").alias("name")
    )


@query(
    "S24",
    """SELECT event_id || '-0' AS key, event_type AS type, user_id AS user_id, 'log-' || (user_id % 3) AS log,
              event_id || '-0' AS entry FROM events""",
)
def log_entries(t: Tables):
    entries = t("events").select(
        F.concat(F.col("event_id").cast("string"), F.lit("-0")).alias("entry_id"),
        F.create_map(F.lit("type"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string")).alias("fields"),
        F.concat(F.lit("log-"), (F.col("user_id") % 3).cast("string")).alias("log"),
    )
    return R.log_entries_to_records(entries, log=F.col("log")).select(
        "key",
        got("value", "$.type").alias("type"),
        got("value", "$.user", "bigint").alias("user_id"),
        F.col("src_partition")["log"].alias("log"),
        F.col("src_offset")["entryId"].alias("entry"),
    )


@query(
    "S25",
    """WITH e AS (SELECT event_id, user_id % 5 AS channel, CASE WHEN event_id % 7 = 3 THEN event_id * 10 END AS given FROM events),
            g AS (SELECT *, count(given) OVER (PARTITION BY channel ORDER BY event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM e)
       SELECT event_id, channel, coalesce(max(given) OVER (PARTITION BY channel, grp), 0)
          + row_number() OVER (PARTITION BY channel, grp ORDER BY event_id)
          - CASE WHEN grp > 0 THEN 1 ELSE 0 END AS replay_id FROM g""",
)
def replay_ids(t: Tables):
    """Ids of a push feed: given on some messages, counted on from the last one on the others."""
    feed = t("events").selectExpr(
        "event_id",
        "user_id % 5 channel",
        """to_json(named_struct('event', named_struct('replayId', case when event_id % 7 = 3 then event_id * 10 end,
             'kind', event_type))) value""",
    )
    return R.assign_replay_ids(feed, ["channel"], ["event_id"]).select("event_id", "channel", "replay_id")
