"""Ranked lexical search of many queries at once, with the parts they share evaluated once.

Items are multisets of terms. Terms that the same items hold, and then pairs of parts
that stand together in several items, become nodes of a graph that the items share.
Documents are taken in blocks: the contribution of each term to each document of a
block is an accumulator, a node's accumulator is the sum of its parts', made once and used by
every item above it, and an item's scores are the sum of the nodes left of it. All
sums are of integers, so that sharing changes no score. Each task keeps the best
documents of each item, which are then merged.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordflow.operators.staging import materialise, positions

from .common import named, running_total, whole_text

BEST = 20
# Terms of the items of one graph, entries of a block's accumulators, and bytes of graphs sent to the tasks at a time.
GRAPH_TERMS = 1 << 14
BLOCK_ENTRIES = 4 << 20
ROUND_BYTES = 16 << 20
STRETCH = 1 << 20
SALTS = 64

# Bytes that belong to no term become blanks, A-Z become a-z, and all bytes of further characters stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in order, of a long text a stretch at a time."""
    data = text.encode("utf-8", "surrogatepass").translate(_FOLD)
    at = 0
    while len(data) - at > STRETCH:
        cut = data.find(b" ", at + STRETCH)
        if cut < 0:
            break
        yield data[at:cut].split()
        at = cut
    yield data[at:].split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Graph:
    """How items share their sums. Rows 0 to len(words) - 1 are terms; row len(words) + i is parts[i], a list of earlier rows."""

    words: list[bytes]
    parts: list[list[tuple[int, int]]] = field(default_factory=list)
    items: dict[int, list[tuple[int, int]]] = field(default_factory=dict)

    def additions(self) -> int:
        """Sums of accumulators that a block of documents takes."""
        return sum(len(p) - 1 for p in self.parts) + sum(max(0, len(p) - 1) for p in self.items.values())


def shared(items: dict[int, dict[bytes, int]]) -> Graph:
    """The graph of some items: first the sets of terms that the same items hold, then adjacent pairs, most frequent first.

    A part of an item is a row and how often it counts. Parts stand in the order of how many
    items hold them, so that what many items share comes to stand together; each
    round pairs what stands side by side in two items or more, until nothing does.
    """
    graph = Graph(sorted({w for counts in items.values() for w in counts}))
    row = {w: i for i, w in enumerate(graph.words)}
    holders: dict[tuple[int, int], list[int]] = {}
    for item in sorted(items):
        for w, count in items[item].items():
            holders.setdefault((row[w], count), []).append(item)
    held: dict[int, list[tuple[int, int]]] = {item: [] for item in items}
    same: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    for part, of in holders.items():
        same.setdefault(tuple(of), []).append(part)

    def node(parts: list[tuple[int, int]]) -> tuple[int, int]:
        graph.parts.append(parts)
        return len(graph.words) + len(graph.parts) - 1, 1

    for of, parts in sorted(same.items()):
        if len(of) > 1 and len(parts) > 1:
            parts = [node(sorted(parts))]
        for item in of:
            held[item] += parts
    while True:
        often = Counter(p for parts in held.values() for p in parts)
        for item, parts in held.items():
            held[item] = sorted(parts, key=lambda p: (-often[p], p))
        pairs = Counter(pair for parts in held.values() for pair in zip(parts, parts[1:]))
        chosen: dict[tuple, tuple[int, int]] = {}
        taken: set[tuple[int, int]] = set()
        for pair, count in sorted(pairs.items(), key=lambda x: (-x[1], x[0])):
            if count > 1 and taken.isdisjoint(pair):
                taken.update(pair)
                chosen[pair] = node(list(pair))
        if not chosen:
            break
        for item, parts in held.items():
            out, at = [], 0
            while at < len(parts):
                one = chosen.get(tuple(parts[at : at + 2]))
                out.append(parts[at] if one is None else one)
                at += 1 if one is None else 2
            held[item] = out
    graph.items = held
    return graph


def _packed(graph: Graph) -> bytes:
    import pickle

    return pickle.dumps((graph.words, graph.parts, graph.items), protocol=5)


def _unpacked(raw: bytes) -> Graph:
    import pickle

    return Graph(*pickle.loads(raw))


def _item_terms(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            t = batch.slice(at, 64)
            counts = [Counter(w for part in terms(x) for w in part) for x in t["_text"].to_pylist()]
            words = [sorted(c) for c in counts]
            columns = {
                "item_id": t["item_id"],
                "_hash": t["_hash"],
                "words": pa.array(words, pa.list_(pa.binary())),
                "counts": pa.array([[c[w] for w in ws] for c, ws in zip(counts, words)], pa.list_(pa.int64())),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _graphs(batches):
    """One graph per block of items; items come sorted by block."""
    block, items = None, {}

    def made():
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([_packed(shared(items))], pa.binary())], ["block", "graph"])

    for batch in batches:
        for at in range(batch.num_rows):
            t = batch.slice(at, 1)
            number = t["_block"][0].as_py()
            if number != block:
                if items:
                    yield made()
                block, items = number, {}
            items[t["_item"][0].as_py()] = dict(zip(t["words"][0].as_py(), t["counts"][0].as_py()))
    if items:
        yield made()


def _postings(words) -> Callable:
    """Each document's terms, as far as an item has them: their numbers and frequencies."""

    def run(batches):
        number = {w: i for i, w in enumerate(words.value)}
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                t = batch.slice(at, 64)
                lengths, found = [], []
                for text in t["_text"].to_pylist():
                    n, counts = 0, Counter()
                    for part in terms(text):
                        n += len(part)
                        counts.update(filter(number.__contains__, part))
                    lengths.append(n)
                    found.append(counts)
                ids = [list(map(number.__getitem__, c)) for c in found]
                columns = {
                    "doc_id": t["doc_id"],
                    "n": pa.array(lengths, pa.int64()),
                    "terms": pa.array(ids, pa.list_(pa.int32())),
                    "tfs": pa.array([list(c.values()) for c in found], pa.list_(pa.int64())),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


class _Best:
    """The best documents of an item so far, as (score, document), in the order of results."""

    def __init__(self, kept: int):
        self.kept, self.rows, self.least = kept, [], 1

    def add(self, scores: np.ndarray, docs: list) -> None:
        for i in np.flatnonzero(scores >= self.least).tolist():
            self.rows.append((-int(scores[i]), docs[i] is None, docs[i] or 0))
        if len(self.rows) > self.kept:
            self.rows = heapq.nsmallest(self.kept, self.rows)
            self.least = -self.rows[-1][0]


def _scored(graphs, weights, n_docs: int, n_terms: int, kept: int, id_type: pa.DataType) -> Callable:
    def run(batches):
        from pyspark import TaskContext

        plans = [_unpacked(raw) for raw in graphs.value]
        number, weight_of = weights.value
        plans = [(g, np.array([number.get(w, -1) for w in g.words], np.int64)) for g in plans]
        rows = max((len(g.words) + len(g.parts) for g, _ in plans), default=1)
        per_block = max(1, BLOCK_ENTRIES // max(1, rows))
        best: dict[int, _Best] = {item: _Best(kept) for g, _ in plans for item in g.items}
        for batch in batches:
            for at in range(0, batch.num_rows, per_block):
                t = batch.slice(at, per_block)
                docs = t["doc_id"].to_pylist()
                terms_of, of = t["terms"].flatten().to_numpy(zero_copy_only=False), t["terms"].value_lengths().to_numpy()
                tf = t["tfs"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                norm = np.array([75 + 25 * n * n_docs // n_terms for n in t["n"].to_pylist()], np.int64)
                column = np.repeat(np.arange(len(docs)), of)
                value = weight_of[terms_of] * (1_000_000_000 * tf // (1000 * tf + 12 * norm[column]))
                for graph, numbers in plans:
                    row_of = np.full(len(weight_of), -1, np.int64)
                    row_of[numbers[numbers >= 0]] = np.flatnonzero(numbers >= 0)
                    here = row_of[terms_of]
                    sums = np.zeros((len(graph.words) + len(graph.parts), len(docs)), np.int64)
                    sums[here[here >= 0], column[here >= 0]] = value[here >= 0]
                    for i, parts in enumerate(graph.parts, len(graph.words)):
                        _sum(sums, parts, sums[i])
                    scores = np.empty(len(docs), np.int64)
                    for item, parts in graph.items.items():
                        if parts:
                            scores[:] = 0
                            best[item].add(_sum(sums, parts, scores), docs)
        task = TaskContext.get().partitionId()
        names = ["_item", "doc_id", "score", "_task"]
        out = [(item, None if none else d, -s, task) for item, b in best.items() for s, none, d in b.rows]
        for at in range(0, len(out), 4096):
            columns = zip(zip(*out[at : at + 4096]), (pa.int64(), id_type, pa.int64(), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names)

    return run


def _sum(sums: np.ndarray, parts: list[tuple[int, int]], out: np.ndarray) -> np.ndarray:
    for row, count in parts:
        if count == 1:
            out += sums[row]
        else:
            out += count * sums[row]
    return out


def graphs_of(items: DataFrame, graph_terms: int = GRAPH_TERMS) -> DataFrame:
    """The graphs of all items: block, graph. ``items``: _item (number), words, counts, _terms (words of the items before)."""
    blocks = items.withColumn("_block", F.floor(F.col("_terms") / graph_terms).cast("long"))
    dealt = blocks.select("_block", "_item", "words", "counts").repartition("_block").sortWithinPartitions("_block", "_item")
    return materialise(dealt.mapInArrow(_graphs, "block long, graph binary"))


def search(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    best: int = BEST,
    graph_terms: int = GRAPH_TERMS,
    round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """The ``best`` highest-scoring rows of ``docs`` for each row of ``items``: item_id, rank (from 1), doc_id (an integer), score.

    A text's terms are runs of letters, digits and characters beyond ASCII; A-Z count as a-z. Null
    and empty texts have none: such documents are never found, and such items find nothing. Weights and
    lengths come from all rows. Equal scores rank by ascending doc_id, null ids last; rows that repeat
    a document rank one behind the other. Items with equal ids are ranked each on its own (equal rows of items too).
    Empty tables give an empty result. Further columns are not read.

    Scale: documents do not move. They are read once per round of graphs (one round up to ROUND_BYTES of
    graphs, then as many as the items need), which leaves what items ask of each document: numbers and
    frequencies of terms. These are scored in blocks of BLOCK_ENTRIES sums, and a task returns ``best`` rows
    per item. Merging deals the rows of an item out over SALTS groups first.
    """
    asked = named(items, {"item_id": item_id, "_text": item_text})
    asked = asked.select("item_id", F.xxhash64("_text").alias("_hash"), whole_text("_text").alias("_text"))
    id_kind = dict(asked.dtypes)["item_id"]
    asked = materialise(
        asked.mapInArrow(_item_terms, f"item_id {id_kind}, _hash long, words array<binary>, counts array<long>")
    )
    numbered = materialise(
        positions(asked, ["item_id", "_hash"], "_item").withColumns({"_all": F.lit(0), "_size": F.size("words").cast("long")})
    )
    placed = materialise(running_total(numbered, ["_all"], ["_item"], "_size", "_terms"))
    graphs = graphs_of(placed, graph_terms)
    sizes = running_total(graphs.select("block", F.octet_length("graph").cast("long").alias("_size"), F.lit(0).alias("_all")), ["_all"], ["block"], "_size", "_before")
    dealt = materialise(sizes.select("block", F.floor(F.col("_before") / round_bytes).cast("long").alias("_round")).join(graphs, "block"))
    last = dealt.agg(F.max("_round")).first()[0]
    rows = named(docs, {"doc_id": doc_id, "_text": text}).select(
        F.col("doc_id").cast("long"), whole_text("_text").alias("_text")
    )
    found = None
    for number in range(0 if last is None else last + 1):
        some = _round(rows, dealt.filter(F.col("_round") == number).select("graph"), best)
        found = some if found is None else found.unionByName(some)
    spark = docs.sparkSession
    if found is None:
        found = spark.createDataFrame([], "_item long, doc_id long, score long, _task long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    place = F.row_number().over(Window.partitionBy("_item", "_salt").orderBy(*order))
    fewer = found.withColumn("_salt", F.col("_task") % SALTS).withColumn("_place", place).filter(F.col("_place") <= best)
    rank = F.row_number().over(Window.partitionBy("_item").orderBy(*order))
    ranked = fewer.withColumn("rank", rank).filter(F.col("rank") <= best)
    return ranked.join(placed.select("_item", "item_id"), "_item").select("item_id", "rank", "doc_id", "score")


def _round(rows: DataFrame, graphs: DataFrame, best: int) -> DataFrame:
    """Rows found for the items of some graphs, whose size is bounded: the best of each task."""
    sc = rows.sparkSession.sparkContext
    raw = [bytes(r.graph) for r in graphs.collect()]  # at most ROUND_BYTES, and one graph
    words = sorted({w for g in raw for w in _unpacked(g).words})
    held = materialise(
        rows.mapInArrow(_postings(sc.broadcast(words)), "doc_id long, n long, terms array<int>, tfs array<long>")
    )
    total = held.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    # One row per term of the graphs.
    df = {r.term: r.df for r in held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}
    weights = np.array([weight(total.docs, df[i]) if i in df else 0 for i in range(len(words))], np.int64)
    number = {w: i for i, w in enumerate(words)}
    kinds = "_item long, doc_id long, score long, _task long"
    run = _scored(sc.broadcast(raw), sc.broadcast((number, weights)), total.docs, max(1, total.terms or 0), best, pa.int64())
    return held.filter(F.size("terms") > 0).mapInArrow(run, kinds)


__all__ = ["Graph", "search", "shared", "terms", "weight"]
