"""Byte-level BPE encoding and decoding of whole texts, long ones in overlapping chunks.

A text longer than a chunk is cut into chunks that overlap. Each chunk is split
into pre-tokens on its own, in parallel, although it may begin inside one. Two
neighbours are stitched at the first place in their overlap where both see a
pre-token begin: from there on they agree, since what follows a boundary does not
depend on what came before. The pieces between stitches are then encoded, in
parallel again, and their ids joined in order. A document with an overlap in
which no place is shared (one pre-token longer than the overlap) is encoded as
one chunk. Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, named, whole_text

CHUNK = 65_536
OVERLAP = 1_024
# A pre-token is only certain when this many characters follow it, as the pattern looks ahead.
AHEAD = 8
# Ids of pre-tokens kept per task.
KEPT_PIECES = 100_000


def read_ranks(path: str) -> bytes:
    """The vocabulary file, read on the driver and sent to the tasks; its size is that of the vocabulary."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}


def boundaries(pattern, text: str, start: int, upto: int) -> Iterator[int]:
    """Places where a pre-token begins, from ``start`` (taken as one) to ``upto``."""
    for m in pattern.finditer(text, start):
        if m.start() > upto:
            return
        yield m.start()


def stitch(pattern, left: str, right: str, at: int) -> int | None:
    """Where both chunks see a boundary, as a place in ``left``; ``right`` begins at ``at`` of it."""
    sure = len(left) - AHEAD
    theirs = {at + b for b in boundaries(pattern, right, 0, sure - at)} - {at}
    return next((b for b in boundaries(pattern, left, 0, sure) if b in theirs), None)


def _tables(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches in slices of a few rows, so that what is made of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class _Encoder:
    """Built once per task from the vocabulary."""

    def __init__(self, raw: bytes, pattern: str):
        import regex
        import tiktoken

        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=parse_ranks(raw), special_tokens={})
        self.piece_ids: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        """Ids of a text that is one chunk."""
        return array("I", self.encoding.encode_ordinary(text)).tobytes()

    def pieces(self, text: str, start: int, end: int | None) -> bytes:
        """Ids of the pre-tokens from one boundary to another (to the end if None)."""
        known, out = self.piece_ids, []
        for m in self.pattern.finditer(text, start):
            if end is not None and m.start() >= end:
                break
            piece = m.group()
            ids = known.get(piece)
            if ids is None:
                if len(known) >= KEPT_PIECES:
                    known.clear()
                ids = known[piece] = array("I", self.encoding._core_bpe.encode_single_piece(piece.encode())).tobytes()
            out.append(ids)
        return b"".join(out)


def _of_wholes(raw: bytes, pattern: str) -> Callable:
    def run(batches):
        encoder = _Encoder(raw, pattern)
        for t in _tables(batches):
            ids = [encoder.whole(text) for text in t["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([t["doc_id"], pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return run


def _cut(chunk: int, overlap: int) -> Callable:
    def run(batches):
        for t in _tables(batches, 1):
            text, doc_id = t["_text"][0].as_py(), t["doc_id"][0].as_py()
            # Rows that repeat an id and a text have one key, and one result.
            key = hashlib.sha256(repr(doc_id).encode() + b"|" + text.encode()).digest()
            last = max(1, -(-(len(text) - overlap) // chunk)) - 1
            for at in range(0, last + 1, 64):
                ats = list(range(at, min(at + 64, last + 1)))
                pieces = [text[a * chunk : None if a == last else (a + 1) * chunk + overlap] for a in ats]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * len(ats), pa.binary()),
                        pa.array([doc_id] * len(ats), t.schema.field("doc_id").type),
                        pa.array(ats, pa.int64()),
                        pa.array([a == last for a in ats], pa.bool_()),
                        pa.array(pieces, pa.string()),
                    ],
                    ["key", "doc_id", "at", "is_last", "chunk"],
                )

    return run


def _find_stitches(pattern: str, chunk: int) -> Callable:
    """Per chunk but the last: where the next one begins to count, in characters of the next one; -1: nowhere."""

    def run(batches):
        import regex

        compiled = regex.compile(pattern)
        for t in _tables(batches):
            found = [stitch(compiled, text, text[chunk:], chunk) for text in t["chunk"].to_pylist()]
            starts = [-1 if p is None else p - chunk for p in found]
            ats = [a + 1 for a in t["at"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [t["key"], pa.array(ats, pa.int64()), pa.array(starts, pa.int64())], ["key", "at", "start"]
            )

    return run


def _of_chunks(raw: bytes, pattern: str, chunk: int) -> Callable:
    def run(batches):
        encoder = _Encoder(raw, pattern)
        for t in _tables(batches):
            ids = []
            for text, start, is_last in zip(t["chunk"].to_pylist(), t["start"].to_pylist(), t["is_last"].to_pylist()):
                end = None if is_last else stitch(encoder.pattern, text, text[chunk:], chunk)
                ids.append(encoder.pieces(text, start, end))
            columns = [*(t[c] for c in ("key", "doc_id", "at", "_rows")), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "at", "_rows", "ids"])

    return run


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    doc_id: str = "doc_id",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Every row's ids: doc_id, ids (little-endian unsigned 32-bit integers as binary), n_tokens.

    Each match of ``pattern`` is encoded on its own, without special tokens. Null and
    empty texts have no ids. Repeated rows give repeated results, a null id is kept.
    An empty table gives an empty result. Other columns are not read.

    Scale: texts of up to chunk + overlap characters are encoded where they are read.
    Only chunks of longer ones move, by a key of their own, so one text of any
    length is spread over the cluster. A task holds some hundred texts at a time.
    """
    raw = read_ranks(ranks_path)
    rows = named(docs, {"doc_id": doc_id, "_text": text}).select("doc_id", whole_text("_text").alias("_text"))
    id_type = dict(rows.dtypes)["doc_id"]
    result = f"doc_id {id_type}, ids binary"
    is_long = F.length("_text") > chunk + overlap
    short = rows.filter(~is_long).mapInArrow(_of_wholes(raw, pattern), result)
    cut = rows.filter(is_long).mapInArrow(
        _cut(chunk, overlap), f"key binary, doc_id {id_type}, at long, is_last boolean, chunk string"
    )
    # Repeated rows become one before their chunks move.
    chunks = cut.groupBy("key", "at", "is_last").agg(
        F.first("doc_id").alias("doc_id"), F.first("chunk").alias("chunk"), F.count(F.lit(1)).alias("_rows")
    )
    starts = materialise(
        chunks.filter("not is_last").mapInArrow(_find_stitches(pattern, chunk), "key binary, at long, start long")
    )
    apart = starts.filter("start < 0").select("key").distinct()
    begun = chunks.join(starts, ["key", "at"], "left").withColumn("start", F.coalesce("start", F.lit(0)))
    stitched = begun.join(apart, "key", "left_anti").mapInArrow(
        _of_chunks(raw, pattern, chunk), f"key binary, doc_id {id_type}, at long, _rows long, ids binary"
    )
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("at", "ids"))), lambda x: F.hex(x["ids"]))
    long = stitched.groupBy("key").agg(
        F.unhex(F.array_join(in_order, "")).alias("ids"), F.first("doc_id").alias("doc_id"), F.max("_rows").alias("_rows")
    )
    repeat = F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int")))
    every = short.unionByName(long.withColumn("_row", repeat).select("doc_id", "ids"))
    if not apart.isEmpty():
        # A pre-token longer than the overlap: these texts are put together again and encoded as one chunk.
        parts = F.array_sort(F.collect_list(F.struct("at", "is_last", "chunk")))
        own = F.transform(parts, lambda x: F.when(x["is_last"], x["chunk"]).otherwise(F.substring(x["chunk"], 1, chunk)))
        together = chunks.join(apart, "key", "left_semi").groupBy("key").agg(
            F.array_join(own, "").alias("_text"), F.first("doc_id").alias("doc_id"), F.max("_rows").alias("_rows")
        )
        together = together.withColumn("_row", repeat).select("doc_id", "_text")
        every = every.unionByName(together.mapInArrow(_of_wholes(raw, pattern), result))
    return every.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``: the bytes of each row's ids, in order (null ids: null). A decoded text need not be valid UTF-8 if ids were cut."""
    raw = read_ranks(ranks_path)

    def run(batches):
        tokens = {rank: token for token, rank in parse_ranks(raw).items()}
        for t in _tables(batches):
            made = [
                None if x is None else b"".join(map(tokens.__getitem__, memoryview(x).cast("I")))
                for x in t[ids].to_pylist()
            ]
            columns = [*t.columns, pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*t.schema.names, "decoded"])

    schema = ", ".join(f"`{n}` {k}" for n, k in encoded.dtypes)
    return encoded.mapInArrow(run, f"{schema}, decoded binary")
