"""Masking of JSON text by field name and by value pattern, and the way back.

The JSON text is cut into tokens (keys, string values, the rest) by one regular
expression, so masking works at any depth without leaving the JVM. Key order and
spacing of the record stay as they were.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V
from .staging import compute_once

# Either a key with its colon, or a string value, or a run of anything else, or (in broken text) a lone quote.
_TOKEN = V.STRING_LITERAL + r"\s*+:?|[^\"]++|\""
_MARK = "[MASKED_"
# A placeholder, or a run of other text.
_PLACEHOLDER = r"\[MASKED_[0-9a-z_]*+\]|[^\[]++|\["
# A pattern that begins with a repeated plain class of characters.
_REPEATED = re.compile(r"(\[\^?[^\^\[\]\\&][^\[\]\\&]*\])\+\??(?![+*?{])")


def _searched(pattern: str) -> str:
    """A pattern found in the same texts: where one of a class is followed by the rest, so are many of it.

    The repetition would be tried anew from every character of a word.
    """
    return _REPEATED.sub(r"\1", pattern, count=1) if _REPEATED.match(pattern) else pattern


def _is_key(token: Column) -> Column:
    return token.startswith('"') & token.endswith(":")


def _key_name(token: Column) -> Column:
    bare = F.substring(token, F.lit(2), F.length(token) - 3)
    name = V.string_text(F.regexp_replace(token, r"\s*:$", ""))
    return F.lower(F.when(token.endswith('":') & ~token.contains("\\"), bare).otherwise(name))


def _is_text(token: Column) -> Column:
    return token.startswith('"') & ~token.endswith(":") & (F.length(token) > 1)


def _owner(tokens: Column, i: Column) -> Column:
    """The key a value belongs to: directly before it, or with only blanks between."""
    before = F.when(i >= 1, F.get(tokens, i - 1))
    skipped = F.when((i >= 2) & (F.trim(F.regexp_replace(before, r"\s+", "")) == ""), F.get(tokens, i - 2))
    return F.coalesce(F.when(_is_key(before), before), F.when(_is_key(skipped), skipped))


def mask(
    df: DataFrame,
    fields: tuple[str, ...] | list[str] = (),
    patterns: tuple[str, ...] | list[str] = (),
    style: str = "numbered",
    replacement: str = "[MASKED]",
    value: str = "value",
    out_map: str = "mask_map",
) -> DataFrame:
    """Replace matching text values by placeholders; ``mask_map`` holds placeholder to original.

    A field name matches in any case and at any depth, a pattern anywhere inside
    a text value; the whole value is replaced. Placeholders are numbered per
    record in reading order; a record that itself holds the text of a placeholder
    gets placeholders with a mark of its own. ``style="constant"`` uses one fixed
    text and keeps no map. Text that is not JSON (or has something behind it) is
    masked alike, and replaced as a whole if a pattern still matches anywhere in it.
    """
    if style not in ("numbered", "constant"):
        raise ValueError(f"unknown mask style: {style}")
    lowered = [f.lower() for f in fields]
    patterns = [_searched(p) for p in patterns]
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    if not lowered and not patterns:
        return df.withColumn(out_map, empty)

    tokens = F.col("_tokens")
    staged = compute_once(df, {"_tokens": F.regexp_extract_all(F.col(value), F.lit(_TOKEN), F.lit(0))})

    def hits(token: Column, i: Column) -> Column:
        tests = []
        if lowered:
            owner = _owner(tokens, i)
            tests.append(F.coalesce(owner.isNotNull() & _key_name(owner).isin(*lowered), F.lit(False)))
        if patterns:
            text = V.string_text(token)
            tests.append(F.coalesce(reduce(lambda a, b: a | b, [text.rlike(p) for p in patterns]), F.lit(False)))
        return _is_text(token) & reduce(lambda a, b: a | b, tests)

    staged = compute_once(
        staged,
        {"_at": F.filter(F.transform(tokens, lambda t, i: F.when(hits(t, i), i)), lambda i: i.isNotNull())},
    )
    # A text that holds a placeholder already gets others, so that none is taken for another.
    own = F.when(F.col(value).contains(_MARK), F.concat(F.substring(F.md5(F.col(value)), 1, 12), F.lit("_"))).otherwise("")
    if style == "constant":
        named = lambda n: F.lit(replacement)
        made_map = empty
    else:
        named = lambda n: F.concat(F.lit(_MARK), own, n.cast("string"), F.lit("]"))
        made_map = F.map_from_entries(
            F.transform(
                F.col("_at"),
                lambda i, n: F.struct(named(n).alias("key"), V.string_text(F.get(tokens, i)).alias("value")),
            )
        )
    # Per placeholder the tokens since the one before it, then the rest: no token is looked up among all places.
    at = F.col("_at")
    since = lambda n: F.when(n > 0, F.get(at, n - 1) + 1).otherwise(0)
    kept = lambda start, end: F.array_join(F.slice(tokens, start + 1, end - start), "")
    replaced = F.transform(at, lambda i, n: F.concat(kept(since(n), i), F.lit('"'), named(n), F.lit('"')))
    rewritten = F.concat(F.array_join(replaced, ""), kept(since(F.size(at)), F.size(tokens)))
    touched = F.size("_at") > 0
    masked = compute_once(
        staged,
        {
            out_map: F.when(touched, made_map).otherwise(empty),
            "_masked": F.when(touched, rewritten).otherwise(F.col(value)),
        },
    ).drop("_tokens", "_at")
    if not patterns:
        return masked.withColumn(value, F.col("_masked")).drop("_masked")
    # What the reader of tokens cannot see in broken text is looked for in the text as a whole.
    anywhere = reduce(lambda a, b: a | b, [F.col("_masked").rlike(p) for p in patterns])
    whole = anywhere & ~V.is_strict(F.col(value))
    whole_map = empty if style == "constant" else F.create_map(named(F.lit(0)), F.col(value))
    return compute_once(
        compute_once(masked, {"_whole": F.coalesce(whole, F.lit(False))}),
        {
            out_map: F.when(F.col("_whole"), whole_map).otherwise(F.col(out_map)),
            value: F.when(F.col("_whole"), named(F.lit(0))).otherwise(F.col("_masked")),
        },
    ).drop("_masked", "_whole")


def unmask(df: DataFrame, value: str = "value", mask_map: str = "mask_map", enabled: bool = True) -> DataFrame:
    """Put the originals back, escaped for JSON. Does nothing when disabled."""
    if not enabled:
        return df
    escaped = lambda text: F.substring(F.to_json(F.array(text)), 3, 2147483647)
    body = lambda text: F.regexp_replace(escaped(text), r'"\]$', "")
    # One pass over the text: what was put back is not looked at again.
    found = F.regexp_extract_all(F.col(value), F.lit(_PLACEHOLDER), F.lit(0))
    put_back = F.transform(
        found, lambda t: F.when(F.map_contains_key(mask_map, t), body(F.element_at(mask_map, t))).otherwise(t)
    )
    alone = F.element_at(mask_map, F.col(value))  # a text masked as a whole comes back as it was
    restored = F.coalesce(alone, F.array_join(put_back, ""))
    has_marks = (F.size(F.map_keys(mask_map)) > 0) & F.col(value).contains(_MARK)
    return compute_once(df, {value: F.when(has_marks, restored).otherwise(F.col(value))})


def masked_stage(df: DataFrame, work, fields=(), patterns=(), restore: bool = True, value: str = "value") -> DataFrame:
    """mask, run ``work`` (DataFrame to DataFrame, keeping ``mask_map``), unmask."""
    return unmask(work(mask(df, fields, patterns, value=value)), value, enabled=restore).drop("mask_map")
