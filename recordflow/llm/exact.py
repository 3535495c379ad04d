"""Exact duplicates by deterministic block naming, in DataFrame operations only.

A normalised text is cut into blocks of a fixed number of characters. The distinct
blocks are sorted and numbered; a document becomes its list of numbers. Then
adjacent numbers are paired, the distinct pairs sorted and numbered, and so on
until one number is left: with the number of blocks it identifies the text.
Numbers stand for values that were compared in full, so no two texts share one.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, join_groups, keep_one, materialise, named, whole_text


def normalised(text: str = "text") -> Column:
    """Every run of blanks as one space; null as empty."""
    return F.regexp_replace(whole_text(text), SPACES, " ")


def _blocks(chars: int) -> Column:
    """The blocks of ``_norm``; the empty text is one empty block."""
    cut = F.regexp_extract_all("_norm", F.lit(f"(?s).{{1,{chars}}}"), F.lit(0))
    return F.when(F.length("_norm") == 0, F.array(F.lit(""))).otherwise(cut)


def _key(block: Column | str, seed: int) -> list[Column]:
    """128 bits that stand for a block in joins; ``_numbered`` proves them free of collisions."""
    return [F.xxhash64(F.lit(seed), block).alias("_h1"), F.xxhash64(block, F.lit(seed)).alias("_h2")]


def _numbered(values: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Distinct values with a number each, in sorted order within a partition, and how often they occur.

    Stored, so that the numbers stay the same however often they are read.
    """
    distinct = values.groupBy(*values.columns).agg(F.count(F.lit(1)).alias("_members"))
    ordered = distinct.sortWithinPartitions(*values.columns)
    return materialise(ordered.select(*keys, "_members", F.monotonically_increasing_id().alias(number)))


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block_chars: int = 8192) -> DataFrame:
    """Every row with the row that stands for its text: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after runs of blanks became one space. The
    smallest doc_id stays; a null one counts as largest. Null text is empty text.
    Of repeated rows (same id, same text) exactly one is kept, whichever; a doc_id
    with different texts is judged per text. An empty table gives an empty result.
    Other columns are not read.

    Scale: texts move once, after equal blocks were merged on the map side; all
    else moves numbers. Rounds: the logarithm of the blocks of the longest text.
    """
    rows = named(docs, {"doc_id": doc_id, "_text": text}).select("doc_id", normalised("_text").alias("_norm"))
    for seed in count():
        keyed = F.transform(_blocks(block_chars), lambda b: F.struct(*_key(b, seed)))
        slim = materialise(
            rows.select(
                F.monotonically_increasing_id().alias("_row"),
                "doc_id",
                F.sha2("_norm", 256).alias("text_sha256"),
                keyed.alias("_keys"),
            )
        )
        blocks = rows.select(F.explode(_blocks(block_chars)).alias("_block"))
        names = _numbered(blocks.select(*_key("_block", seed), "_block"), ["_h1", "_h2"], "_name")
        if names.groupBy("_h1", "_h2").count().filter("count > 1").isEmpty():
            break  # one block per key; else the next seed
    parts = slim.select("_row", F.size("_keys").alias("_n"), F.posexplode("_keys").alias("_at", "_k"))
    parts = parts.select("_row", "_n", "_at", "_k._h1", "_k._h2")
    level = materialise(join_groups(parts, names, ["_h1", "_h2"], "_members").select("_row", "_n", "_at", "_name"))
    done = level.filter("_n = 1").select("_row", "_n", "_name")
    level = level.filter("_n > 1")
    while not level.isEmpty():
        half = F.expr("_at div 2").cast("int")
        pairs = materialise(
            level.groupBy("_row", "_n", half.alias("_at")).agg(
                F.max(F.when(F.col("_at") % 2 == 0, F.col("_name"))).alias("_left"),
                # An odd last number is paired with nothing, written as -1.
                F.coalesce(F.max(F.when(F.col("_at") % 2 == 1, F.col("_name"))), F.lit(-1)).alias("_right"),
            )
        )
        names = _numbered(pairs.select("_left", "_right"), ["_left", "_right"], "_name")
        level = materialise(
            join_groups(pairs, names, ["_left", "_right"], "_members").select("_row", "_n", "_at", "_name")
        )
        # After r rounds a text of n blocks has ceil(n / 2^r) numbers; it is done when that is one.
        last = level.groupBy("_n").agg(F.max("_at").alias("_last")).filter("_last = 0").select("_n")
        done = done.unionByName(level.join(last, "_n", "left_semi").select("_row", "_n", "_name"))
        level = level.join(last, "_n", "left_anti")
    return _stays(slim.drop("_keys"), materialise(done))


def _stays(slim: DataFrame, identity: DataFrame) -> DataFrame:
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    rows = materialise(slim.join(identity, "_row"))
    groups = materialise(
        rows.groupBy("_n", "_name")
        .agg(first.alias("_first"), F.count(F.lit(1)).alias("group_size"))
        .select("_n", "_name", "group_size", F.col("_first.doc_id").alias("keep_id"), F.col("_first._row").alias("_keep"))
    )
    return join_groups(rows, groups, ["_n", "_name"], "group_size").select(
        "doc_id", "keep_id", "group_size", (F.col("_row") == F.col("_keep")).alias("kept"), "text_sha256"
    )


def drop_exact(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block_chars: int = 8192) -> DataFrame:
    """One row of each group of equal texts, with all its columns (see ``exact_groups`` for nulls and ties)."""
    groups = materialise(exact_groups(docs, text, doc_id, block_chars))
    kept = groups.groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_key")).agg(
        F.count(F.lit(1)).alias("_rows"), F.bool_or("kept").alias("_kept")
    )
    return keep_one(docs, kept.filter("_kept").drop("_kept"), doc_id, F.sha2(normalised(text), 256))
