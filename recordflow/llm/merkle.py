"""A Merkle manifest of a table as a persistent tree: changed leaves make versions that share all untouched nodes.

Rows are leaves of one tree per source, in ascending order of their id; the roots of
the sources are the leaves of a tree of their own. A node is the hash of up to FAN
consecutive nodes below it. Trees are cut into aligned blocks of FAN^DEPTH leaves: a
task builds the inner levels of one block, the blocks' roots are the leaves of the
next storey, and so on to the root. A changed leaf is a version: its ancestors within
the block are copied, then those in the storeys above, of which the block holds
only the path of its own root (the neighbours at each level, handed down storey by
storey). All other nodes stay those of the first version and are not written again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordflow.operators.staging import materialise, ordered_chunks, positions

from .common import named

FAN, DEPTH = 16, 3
BLOCK = FAN**DEPTH
HEX = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TREE = ["_has", "_src"]


def _hash(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def framed(column: Column) -> Column:
    """A value by the count of its UTF-8 bytes, a colon and its text; null is '-'."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[framed(c) for c in columns]), 256)


def heights(n: int) -> int:
    """Levels above the leaves of a tree with n leaves."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


def levels(digests: list[bytes], times: int) -> list[list[bytes]]:
    """The nodes of a block, level by level, the given ones first."""
    out = [digests]
    for _ in range(times):
        last = out[-1]
        out.append([_hash(b"".join(last[i : i + FAN])) for i in range(0, len(last), FAN)])
    return out


def path(made: list[list[bytes]], at: int) -> list[tuple[bytes, bytes]]:
    """What stands left and right of a node and of its ancestors, in their runs."""
    out = []
    for nodes in made[:-1]:
        run = at - at % FAN
        out.append((b"".join(nodes[run:at]), b"".join(nodes[at + 1 : run + FAN])))
        at //= FAN
    return out


def copied(leaf: bytes, ways: list[tuple[bytes, bytes]]) -> list[bytes]:
    """The ancestors of a changed leaf, from its parent to the root: all nodes that its version does not share."""
    out = []
    for left, right in ways:
        leaf = _hash(left + leaf + right)
        out.append(leaf)
    return out


def _blocks(batches, columns: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that come sorted by tree and block, a block at a time, however batches are cut: (tree, block) and rows."""
    key, held = None, []
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            t = batch.slice(start, 4096)
            for row in zip(*(t[c].to_pylist() for c in columns)):
                if row[:3] != key:
                    if held:
                        yield key, held
                    key, held = row[:3], []
                held.append(row[3:])
    if held:
        yield key, held


def _in_blocks(rows: DataFrame) -> DataFrame:
    """A block of at most BLOCK leaves in one task, its rows in order."""
    rows = rows.withColumn("_block", F.shiftright("_pos", DEPTH * 4))
    return rows.repartition(*TREE, "_block").sortWithinPartitions(*TREE, "_block", "_pos")


def _flushed(made: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names)


_TREE_KINDS = [pa.bool_(), pa.string()]


def _climb(batches):
    """The root of each block, as a node of the next storey."""
    out, names = [], [*TREE, "_pos", "_n", "_digest"]
    for (has, src, block), rows in _blocks(batches, [*TREE, "_block", "_n", "_digest"]):
        n = rows[0][0]
        made = levels([d.encode() for _, d in rows], min(DEPTH, heights(n)))
        out.append((has, src, block, -(-n // BLOCK), made[-1][0].decode()))
        if len(out) >= 1024:
            yield _flushed(out, names, [*_TREE_KINDS, pa.int64(), pa.int64(), pa.string()])
            out = []
    if out:
        yield _flushed(out, names, [*_TREE_KINDS, pa.int64(), pa.int64(), pa.string()])


def _inner_paths(batches):
    """The path of each node to the root of its block."""
    names, sides = [*TREE, "_pos", "_left", "_right"], pa.list_(pa.string())
    for (has, src, block), rows in _blocks(batches, [*TREE, "_block", "_pos", "_n", "_digest"]):
        made = levels([d.encode() for *_, d in rows], min(DEPTH, heights(rows[0][1])))
        for start in range(0, len(rows), 256):
            out = []
            for at in range(start, min(start + 256, len(rows))):
                ways = path(made, at)
                out.append((has, src, rows[at][0], [x.decode() for x, _ in ways], [y.decode() for _, y in ways]))
            yield _flushed(out, names, [*_TREE_KINDS, pa.int64(), sides, sides])


_NODES = "_has boolean, _src string, _pos long, _n long, _digest string"
_PATHS = "_has boolean, _src string, _pos long, _left array<string>, _right array<string>"


def _storeys(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Roots of the trees over given nodes, and every node's path to the root of its tree.

    A storey has a BLOCK-th of the rows of the one below, so this ends after a few.
    """
    blocks = _in_blocks(nodes)
    above = materialise(blocks.mapInArrow(_climb, _NODES))
    inner = blocks.mapInArrow(_inner_paths, _PATHS)
    if above.filter("_n > 1").isEmpty():
        return above, inner
    roots, outer = _storeys(above)
    outer = outer.select(*TREE, F.col("_pos").alias("_up"), F.col("_left").alias("_l"), F.col("_right").alias("_r"))
    joined = inner.withColumn("_up", F.shiftright("_pos", DEPTH * 4)).join(outer, [*TREE, "_up"])
    paths = joined.select(
        *TREE, "_pos", F.concat("_left", "_l").alias("_left"), F.concat("_right", "_r").alias("_right")
    )
    return roots, materialise(paths)


def placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their place in their source (_pos) and the rows of the source (_n).

    One shuffle by ranges of (source, order): a source with a third of all rows lies
    in many ranges, and what goes between ranges is one row per source and range.
    """
    tagged = ordered_chunks(leaves, [*TREE, *order])
    earlier = Window.partitionBy(*TREE).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = tagged.groupBy(*TREE, "_chunk").agg(F.count(F.lit(1)).alias("_rows"), F.min("_rank").alias("_first"))
    bases = sums.select(
        *TREE,
        "_chunk",
        "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"),
        F.sum("_rows").over(Window.partitionBy(*TREE)).alias("_n"),
    )
    joined = tagged.join(bases, [*TREE, "_chunk"])
    return joined.withColumn("_pos", F.col("_base") + F.col("_rank") - F.col("_first")).drop(
        "_chunk", "_rank", "_first", "_base"
    )


@dataclass
class Manifest:
    """The first version of a tree, and the changed leaves that make further ones.

    ``leaves``: _has, _src, _pos, _n, doc_id, _digest, _changed (null: as it was).
    ``paths``: one row per block: how its root leads to the root of all.
    """

    leaves: DataFrame
    paths: DataFrame

    def _each(self, run: Callable, schema: str) -> DataFrame:
        """Blocks with the path of their root, which comes before their leaves."""
        none = [F.lit(None).cast("array<string>").alias(c) for c in ("_left", "_right")]
        ends = [F.lit(None).cast("string").alias(c) for c in ("_subroot", "_root")]
        rows = self.leaves.select(*TREE, F.shiftright("_pos", DEPTH * 4).alias("_block"), "_pos", "_n", "doc_id", "_digest", "_changed", *none, *ends)
        like = dict(self.leaves.dtypes)["doc_id"]
        heads = self.paths.select(
            *TREE, "_block", F.lit(-1).cast("long").alias("_pos"), F.lit(0).cast("long").alias("_n"),
            F.lit(None).cast(like).alias("doc_id"), *[F.lit(None).cast("string").alias(c) for c in ("_digest", "_changed")],
            "_left", "_right", "_subroot", "_root",
        )
        both = rows.unionByName(heads).repartition(*TREE, "_block").sortWithinPartitions(*TREE, "_block", "_pos")
        return both.mapInArrow(run, schema)

    def proofs(self) -> DataFrame:
        """Every row: doc_id, leaf, subroot, root, proof_sha256 (hash of its siblings, level by level), folded_root
        (recomputed from the changed leaf, else the leaf), verified (whether that is the root)."""
        kind = dict(self.leaves.dtypes)["doc_id"]
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

        def run(batches):
            kinds = None
            for block, doc_type in _with_heads(batches):
                kinds = kinds or [doc_type, *[pa.string()] * 5, pa.bool_()]
                out = []
                for doc_id, leaf, changed, ways in block.walk():
                    root = block.root
                    siblings = hashlib.sha256(b"".join(left + right for left, right in ways)).hexdigest()
                    way = copied((changed or leaf).encode(), ways)
                    folded = way[-1].decode() if way else changed or leaf
                    out.append((doc_id, leaf, block.subroot, root, siblings, folded, folded == root))
                    if len(out) >= 1024:
                        yield _flushed(out, names, kinds)
                        out = []
                if out:
                    yield _flushed(out, names, kinds)

        schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return self._each(run, schema)

    def versions(self) -> DataFrame:
        """The nodes each version copies: doc_id (whose leaf was changed), source, leaf_pos, level (0: the leaf), pos, digest.

        Levels go up through the tree of the source, then (level_of 'all') through that of the sources.
        A version's other nodes are those of ``nodes``.
        """
        kind = dict(self.leaves.dtypes)["doc_id"]
        names = ["doc_id", *TREE, "leaf_pos", "level", "digest"]

        def run(batches):
            for block, doc_type in _with_heads(batches):
                kinds = [doc_type, *_TREE_KINDS, pa.int64(), pa.int32(), pa.string()]
                out = []
                for at, (doc_id, _, changed, ways) in enumerate(block.walk()):
                    if changed is None:
                        continue
                    made = [changed, *(d.decode() for d in copied(changed.encode(), ways))]
                    out += [(doc_id, block.has, block.src, block.first + at, k, d) for k, d in enumerate(made)]
                    if len(out) >= 4096:
                        yield _flushed(out, names, kinds)
                        out = []
                if out:
                    yield _flushed(out, names, kinds)

        made = self._each(run, f"doc_id {kind}, _has boolean, _src string, leaf_pos long, level int, digest string")
        return made.select("doc_id", F.when(F.col("_has"), F.col("_src")).alias("source"), "leaf_pos", "level", "digest")

    def nodes(self) -> DataFrame:
        """The nodes of the first version within the blocks: source, level, pos (in its level), digest."""
        names = [*TREE, "level", "pos", "digest"]

        def run(batches):
            for (has, src, block), rows in _blocks(batches, [*TREE, "_block", "_n", "_digest"]):
                made = levels([d.encode() for _, d in rows], min(DEPTH, heights(rows[0][0])))
                out = []
                for k, nodes in enumerate(made):
                    first = block * BLOCK // FAN**k
                    out += [(has, src, k, first + i, d.decode()) for i, d in enumerate(nodes)]
                yield _flushed(out, names, [*_TREE_KINDS, pa.int32(), pa.int64(), pa.string()])

        made = _in_blocks(self.leaves).mapInArrow(run, "_has boolean, _src string, level int, pos long, digest string")
        return made.select(F.when(F.col("_has"), F.col("_src")).alias("source"), "level", "pos", "digest")


class _Block:
    def __init__(self, key: tuple, head: tuple, rows: list[tuple]):
        self.has, self.src, self.number = key
        _, _, _, _, _, left, right, self.subroot, self.root = head
        self.above = [(x.encode(), y.encode()) for x, y in zip(left, right)]
        self.rows, self.first = rows, rows[0][0]
        self.made = levels([r[3].encode() for r in rows], min(DEPTH, heights(rows[0][1])))

    def walk(self) -> Iterator[tuple]:
        """doc_id, leaf, changed leaf and path to the root of all, leaf by leaf."""
        for at, (_, _, doc_id, leaf, changed, *_) in enumerate(self.rows):
            yield doc_id, leaf, changed, path(self.made, at) + self.above


def _with_heads(batches) -> Iterator[tuple[_Block, pa.DataType]]:
    kinds = []

    def noted():
        for batch in batches:
            kinds[:] = [batch.schema.field("doc_id").type]
            yield batch

    columns = [*TREE, "_block", "_pos", "_n", "doc_id", "_digest", "_changed", "_left", "_right", "_subroot", "_root"]
    for key, (head, *rows) in _blocks(noted(), columns):
        if head[0] != -1 or not rows:
            raise ValueError("a block needs the path of its root and at least one leaf")
        yield _Block(key, head, rows), kinds[0]


def manifest(
    docs: DataFrame,
    changed: Column | None = None,
    changed_text: Column | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    text: str = "text",
) -> Manifest:
    """The tree over all rows, and a version for each row where ``changed`` holds, whose text becomes ``changed_text``.

    Both conditions are over columns named as ``fields``, in whose order a leaf hashes a row. Rows of a source stand in ascending id (null ids first); rows that share an
    id in the order of their leaves, equal rows side by side. A null source is a
    source of its own, before all others; the others follow by the bytes of their
    names. Null values hash as '-', empty texts as '0:'. An empty table has a manifest without rows. Further columns are not
    read. Sources with one row have it as their root, and so has a table with one source.

    Scale: texts are hashed where they are read and do not move. What moves are leaves of some hundred
    bytes, in ranges and then in blocks of BLOCK leaves, so no task depends on the size of a
    source; storeys above have a BLOCK-th of the rows each. A block gets the path of its
    root, a kilobyte per level, whatever the number of versions.
    """
    rows = named(docs, {f: f for f in fields} | {"_id": doc_id, "_source": source})
    values = [F.col(f) for f in fields]
    is_changed = F.lit(False) if changed is None else F.coalesce(changed, F.lit(False))
    new = values if changed_text is None else [changed_text if f == text else F.col(f) for f in fields]
    hashed = materialise(
        rows.select(
            F.col("_source").isNotNull().alias("_has"),
            F.coalesce(F.col("_source").cast("string"), F.lit("")).alias("_src"),
            F.col("_id").alias("doc_id"),
            leaf_of(values).alias("_digest"),
            F.when(is_changed, leaf_of(new)).alias("_changed"),
        )
    )
    leaves = materialise(placed(hashed, ["doc_id", "_digest"]))
    above = materialise(_in_blocks(leaves).mapInArrow(_climb, _NODES))
    single = above.select(*TREE, "_pos", F.array().cast("array<string>").alias("_left"), F.array().cast("array<string>").alias("_right"))
    if above.filter("_n > 1").isEmpty():
        subroots, blocks = above, single
    else:  # the storeys above of trees of more than one block
        low, high = above.filter("_n = 1"), above.filter("_n > 1")
        tops, ways = _storeys(high)
        subroots, blocks = low.unionByName(tops), single.join(low, [*TREE, "_pos"], "left_semi").unionByName(ways)
    sources = positions(subroots.select(*TREE, "_digest"), TREE, "_pos").withColumns(
        {"_tree_has": F.col("_has"), "_tree_src": F.col("_src")}
    )
    sources = materialise(sources)
    count = sources.count()
    top = sources.select(
        F.lit(True).alias("_has"), F.lit("").alias("_src"), "_pos", F.lit(count).cast("long").alias("_n"), "_digest"
    )
    roots, ways = _storeys(top)
    own = sources.select("_pos", "_tree_has", "_tree_src", F.col("_digest").alias("_subroot")).join(ways.drop(*TREE), "_pos")
    root = roots.select("_digest").first()  # one row, or none of an empty table
    own = own.select(
        F.col("_tree_has").alias("_has"), F.col("_tree_src").alias("_src"), "_subroot",
        F.lit(None if root is None else root[0]).cast("string").alias("_root"), F.col("_left").alias("_l"), F.col("_right").alias("_r"),
    )
    paths = blocks.join(own, TREE).select(
        *TREE, F.col("_pos").alias("_block"), F.concat("_left", "_l").alias("_left"), F.concat("_right", "_r").alias("_right"), "_subroot", "_root"
    )
    return Manifest(leaves, materialise(paths))


def lower_cased(text: str = "text") -> Column:
    """Only A-Z in lower case."""
    return F.translate(F.col(text), UPPER, LOWER)


__all__ = ["Manifest", "lower_cased", "manifest"]
