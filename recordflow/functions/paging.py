"""Next-page addresses as column expressions; NULL means the last page was reached."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import variant as V

# The wrapper fields looked at first for the list of a page body.
WRAPPERS = ("data", "results", "items", "records")


def _query_of(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(url, r"#.*$", ""), r"\?(.*)$", 1)


def _base_of(url: Column) -> Column:
    return F.regexp_replace(url, r"[?#].*$", "")


def set_param(url: Column, name: str, value: Column) -> Column:
    """Replace a query parameter in place or append it; the value is URL-encoded."""
    pair = F.concat(F.lit(name + "="), F.url_encode(value))
    query = _query_of(url)
    pairs = F.split(query, "&")
    has = F.exists(pairs, lambda p: p.startswith(name + "="))
    replaced = F.transform(pairs, lambda p: F.when(p.startswith(name + "="), pair).otherwise(p))
    return F.concat(
        _base_of(url),
        F.lit("?"),
        F.when(query == "", pair)
        .when(has, F.array_join(replaced, "&"))
        .otherwise(F.concat(query, F.lit("&"), pair)),
    )


def drop_params(url: Column, names: list[str]) -> Column:
    kept = F.filter(
        F.split(_query_of(url), "&"),
        lambda p: ~p.rlike("^(" + "|".join(re.escape(n) for n in names) + ")=") & (p != ""),
    )
    return F.concat(
        _base_of(url), F.when(F.size(kept) == 0, F.lit("")).otherwise(F.concat(F.lit("?"), F.array_join(kept, "&")))
    )


def add_params(url: Column, *pairs: Column) -> Column:
    return F.concat(
        url, F.when(url.contains("?"), F.lit("&")).otherwise(F.lit("?")), F.concat_ws("&", *pairs)
    )


def item_count(body: Column) -> Column:
    """Items of a page body: the root array, a known wrapper field or the first array field; 0 when none."""
    return F.coalesce(F.size(V.first_array_field(body, WRAPPERS)), F.lit(0))


def query_param(url: Column, name: str) -> Column:
    """Raw value of a query parameter, NULL when absent."""
    found = F.regexp_extract(_query_of(url), "(?:^|&)" + re.escape(name) + "=([^&]*)", 1)
    return F.when(_query_of(url).rlike("(?:^|&)" + re.escape(name) + "="), found)


def next_page_url(
    kind: str,
    url: Column,
    body: Column | None = None,
    headers: Column | None = None,
    *,
    cursor_field: str = "next_cursor",
    cursor_param: str = "cursor",
    offset_param: str = "offset",
    limit_param: str = "limit",
    limit: int = 100,
    page_param: str = "page",
    start_page: int = 1,
) -> Column:
    """The next request address for one fetched page. kind: none, cursor, offset, page or link."""
    if kind == "none":
        return F.lit(None).cast("string")
    if kind == "cursor":
        cursor = V.text_of(V.json_path(V.parse(body), cursor_field))
        stop = cursor.isNull() | (cursor == "") | F.is_variant_null(V.json_path(V.parse(body), cursor_field))
        return F.when(~stop, set_param(url, cursor_param, cursor))
    if kind == "offset":
        at = F.coalesce(query_param(url, offset_param).try_cast("bigint"), F.lit(0))
        onward = add_params(
            drop_params(url, [offset_param, limit_param]),
            F.concat(F.lit(offset_param + "="), (at + limit).cast("string")),
            F.lit(f"{limit_param}={limit}"),
        )
        return F.when(item_count(body) >= limit, onward)
    if kind == "page":
        at = F.coalesce(query_param(url, page_param).try_cast("bigint"), F.lit(start_page))
        onward = add_params(
            drop_params(url, [page_param]), F.concat(F.lit(page_param + "="), (at + 1).cast("string"))
        )
        return F.when(item_count(body) > 0, onward)
    if kind == "link":
        relation = r'(?i)<([^>]+)>\s*;\s*rel\s*=\s*"?next"?'
        parts = F.filter(F.split(headers, ","), lambda p: p.rlike(relation))
        found = F.regexp_extract(F.get(parts, 0), relation, 1)
        return F.when(found != "", found)
    raise ValueError(f"unknown paging kind: {kind}")


def first_page_url(
    kind: str,
    url: Column,
    *,
    offset_param: str = "offset",
    limit_param: str = "limit",
    limit: int = 100,
    page_param: str = "page",
    start_page: int = 1,
    **_unused,
) -> Column:
    if kind == "offset":
        return add_params(url, F.lit(f"{offset_param}=0"), F.lit(f"{limit_param}={limit}"))
    if kind == "page":
        return add_params(url, F.lit(f"{page_param}={start_page}"))
    return url
