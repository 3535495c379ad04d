"""Helpers shared by the operators: text rules, joins that survive hot keys, running totals in a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordflow.operators.staging import materialise, ordered_chunks

SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"
# A key with at least this share of the rows counts as hot, so there are at most this many.
HOT_KEYS = 1000


def whole_text(text: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def word_count(text: str = "text") -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORDS)).cast("long")


def named(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the columns an operator needs, under its own names; whatever else the table holds cannot clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], members: str) -> DataFrame:
    """Inner join of rows with one row per key, where ``members`` says how many rows a key has.

    Keys holding a thousandth of all rows or more are at most HOT_KEYS: those are
    broadcast, so that their rows need not move. The others go through a shuffle
    in which no key is large. Read stored frames here: both sides are read twice.
    """
    total = groups.agg(F.sum(members)).first()[0] or 0
    is_hot = F.col(members) * HOT_KEYS >= F.lit(total)
    hot, rest = groups.filter(is_hot), groups.filter(~is_hot)
    here = rows.join(F.broadcast(hot), keys)
    moved = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys)
    return here.unionByName(moved)


def running_total(df: DataFrame, by: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows before this one, per ``by``, in the order given (non-null ``by``).

    Rows are range-partitioned, so that a key with a third of all rows lies in
    many ranges; a range gets the total of the ranges before it from a table with
    one row per key and range.
    """
    tagged = ordered_chunks(df, by + order)
    before = Window.partitionBy(*by, "_chunk").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        tagged.groupBy(*by, "_chunk")
        .agg(F.sum(value).alias("_sum"))
        .select(*by, "_chunk", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    )
    return (
        tagged.withColumn("_inside", F.coalesce(F.sum(value).over(before), F.lit(0)))
        .join(bases, [*by, "_chunk"])
        .withColumn(out, F.col("_base") + F.col("_inside"))
        .drop("_base", "_inside", "_rank")
    )


def keep_one(docs: DataFrame, kept: DataFrame, doc_id: str, key: Column) -> DataFrame:
    """Rows of ``docs`` named by ``kept`` (_id, _key, _rows), all their columns; ``key`` is what a row's _key is made of.

    _rows says how many rows carry that id and key. Those are copies of one row, of which one stays.
    """
    rows = docs.select(packed(docs), F.col(f"`{doc_id}`").alias("id"), key.alias("key"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    once, again = kept.filter("_rows = 1"), kept.filter("_rows > 1")
    found = rows.join(once, same, "left_semi")
    if not again.isEmpty():
        found = found.unionByName(rows.join(again, same, "left_semi").dropDuplicates(["id", "key"]))
    return found.select("doc.*")


def packed(df: DataFrame) -> Column:
    """All columns of a row as one, so that their names cannot clash with an operator's."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc")


__all__ = ["HOT_KEYS", "SPACES", "WORDS", "join_groups", "keep_one", "materialise", "named", "packed", "running_total", "whole_text", "word_count"]
