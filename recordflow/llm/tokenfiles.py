"""Token ids as Parquet files: list columns with dictionary or delta encoding, bounded row groups, page indexes.

A file holds the documents of one range of the order of ids, in that order. Ids lie
in a list column, dictionary-encoded (or as binary-packed deltas); doc_id, counts and
places are plain columns as deltas, so that lengths and starts are read without
any token. Pages are cut after a few hundred rows and have an index of their least and
greatest values, so that a reader of some documents reads only the pages that hold
them. Spark's own writer commits the files: a task that is lost or runs twice
leaves nothing behind.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordflow.operators.staging import ensure_checkpoint_dir, source_bytes

from .common import named, whole_text

ROW_GROUP_BYTES = 32 << 20
PAGE_ROWS = 512
# Stored bytes of text for each file.
FILE_BYTES = 16 << 20
# Pieces whose ids a worker learns before it drops those it has not met since, and bytes of text it looks at together.
KEPT_PIECES = 400_000
STRETCH = 1 << 20

# Kinds of bytes: white space, letters, digits, other ASCII, parts of further characters.
_SPACE, _LETTER, _DIGIT, _MARK, _FURTHER = range(5)
_KINDS = np.array(
    [
        _FURTHER if b >= 128 else _SPACE if b == 32 or 9 <= b <= 13 else _DIGIT if 48 <= b <= 57
        else _LETTER if 65 <= b <= 90 or 97 <= b <= 122 else _MARK
        for b in range(256)
    ],
    np.uint8,
)
# White space beyond ASCII: texts with it are encoded as one.
_further_space = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_visible_then_space = re.compile(rb"[^\t-\r ](?=[\t-\r ])")
# One pre-token for sure: its bytes stand for themselves in the vocabulary, but for the blank.
_single = re.compile(rb" ?(?:[A-Za-z]+|[0-9]+|[!-&(-/:-@\[-`{-~]+)")


def cuts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where pieces begin: pre-tokens begin there too, whatever stands around.

    The pattern of byte-level vocabularies never runs from a visible character into white space, nor
    from a letter into a digit or a mark or the other way round, but that an apostrophe may take letters
    along. White space before a visible character is split alike wherever it stands. ``begins``: starts of texts.
    """
    kind = _KINDS[data]
    before, here = kind[:-1], kind[1:]
    into_space = (here == _SPACE) & (before != _SPACE)
    visible = (here != _SPACE) & (here != _FURTHER) & (before != _SPACE) & (before != _FURTHER)
    cut = np.empty(len(data), bool)
    cut[1:] = into_space | (visible & (here != before) & (data[:-1] != 39))
    cut[begins[begins < len(data)]] = True
    return np.flatnonzero(cut)


def read_vocabulary(path: str) -> str:
    """The tokenizer file, read on the driver and sent to the tasks; its size is that of the vocabulary."""
    with open(path, encoding="utf-8") as f:
        return f.read()


class PieceEncoder:
    """Ids of texts by a byte-level tokenizer of the tokenizers library, which sees each distinct piece once.

    Pieces are independent of each other where the pre-tokenizer is byte-level by its usual
    pattern, without normalizer or added prefix. With others, whole texts are encoded.
    """

    def __init__(self, vocabulary: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        # Special tokens written in a text are ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        made = json.loads(vocabulary)
        before = made.get("pre_tokenizer") or {}
        self.by_piece = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
            and made.get("normalizer") is None
        )
        self.known: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, pieces: list[bytes]) -> None:
        rest = []
        for p in pieces:
            if _single.fullmatch(p):
                found = self.model.tokenize(p.decode().replace(" ", "\u0120"))
                self.known[p] = array("I", [t.id for t in found]).tobytes()
            else:
                rest.append(p)
        if rest:
            found = self.tokenizer.encode_batch_fast([p.decode() for p in rest], add_special_tokens=False)
            self.known.update((p, array("I", e.ids).tobytes()) for p, e in zip(rest, found))

    def _ids_of(self, pieces: list[bytes]) -> list[bytes]:
        known, earlier = self.known, self.earlier
        missing = [p for p in pieces if p not in known]
        if missing:
            known.update((p, earlier[p]) for p in missing if p in earlier)
            self._learn([p for p in missing if p not in earlier])
        ids = list(map(known.__getitem__, pieces))
        if len(known) > KEPT_PIECES:
            self.known, self.earlier = {}, known
        return ids

    def stretch(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some texts laid end to end (``begins``: where each starts), and how many each has."""
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(begins), np.int64)
        starts = cuts(data, begins)
        ends = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, ends, pa.py_buffer(data)]).dictionary_encode()
        ids, code = self._ids_of(pieces.dictionary.to_numpy(zero_copy_only=False).tolist()), pieces.indices.to_numpy()
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        first = np.cumsum(size, dtype=np.int32) - size
        sizes = size[code]
        after = np.cumsum(sizes, dtype=np.int32)
        total = int(after[-1])
        place = np.repeat(first[code] - after + sizes, sizes)
        place += np.arange(total, dtype=np.int32)
        edge = np.append(0, after)[np.searchsorted(starts, np.append(begins, len(data)))]
        return np.frombuffer(b"".join(ids), "<u4")[place], np.diff(edge).astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (non-null), one text's behind the other's, and how many each has."""
        apart = [True] * len(texts)
        if self.by_piece:
            apart = pc.match_substring_regex(texts, _further_space).to_pylist()
        raw = texts.cast(pa.large_string()).cast(pa.large_binary())
        _, at, data = raw.buffers()
        at = np.frombuffer(at, np.int64)[raw.offset : raw.offset + len(raw) + 1]
        data = np.frombuffer(data or b"", np.uint8)
        values, counts = [], np.zeros(len(texts), np.int64)
        row = 0
        while row < len(texts):
            if apart[row]:
                found = self.whole(texts[row].as_py())
                values.append(found)
                counts[row], row = len(found), row + 1
            elif at[row + 1] - at[row] > STRETCH:
                begin, end = int(at[row]), int(at[row + 1])
                while begin < end:
                    cut = _visible_then_space.search(data[begin:end], STRETCH)
                    upto = end if cut is None else begin + cut.end()
                    found, _ = self.stretch(data[begin:upto], np.zeros(1, np.int64))
                    values.append(found)
                    counts[row] += len(found)
                    begin = upto
                row += 1
            else:
                last = row + 1
                while last < len(texts) and not apart[last] and at[last + 1] - at[row] <= STRETCH:
                    last += 1
                found, counts[row:last] = self.stretch(data[at[row] : at[last]], at[row:last] - at[row])
                values.append(found)
                row = last
        return np.concatenate(values) if values else np.empty(0, np.uint32), counts


# The encoder of a process, by its vocabulary: tasks of one worker share what it has learnt.
_held: dict[str, PieceEncoder] = {}


def _encoder(key: str, vocabulary: str) -> PieceEncoder:
    if key not in _held:
        _held.clear()
        _held[key] = PieceEncoder(vocabulary)
    return _held[key]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows whose texts have about a stretch of bytes together."""
    size = np.cumsum(pc.binary_length(batch["_text"]).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(size[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(size, before + STRETCH, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def _rows(vocabulary, key: str, end_id: int) -> Callable:
    """Ids of the documents of a partition, their place in it and the ids before them."""

    def run(batches):
        import os

        from pyspark import TaskContext

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        encoder, part = _encoder(key, vocabulary.value), TaskContext.get().partitionId()
        row, before = 0, 0
        for batch in batches:
            for t in _slices(batch):
                ids, counts = encoder.encode(t["_text"])
                ids = np.insert(ids, np.cumsum(counts), end_id).astype(np.int32)
                counts += 1
                ends = np.cumsum(counts)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids))
                columns = {
                    "doc_id": t["doc_id"],
                    "part": pa.array(np.full(len(counts), part), pa.int32()),
                    "row": pa.array(np.arange(row, row + len(counts))),
                    "before": pa.array(before + ends - counts),
                    "n_tokens": pa.array(counts),
                    "ids": lists,
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
                row, before = row + len(counts), before + int(ends[-1])

    return run


def write(
    docs: DataFrame,
    tokenizer_path: str,
    path: str,
    end_id: int,
    text: str = "text",
    doc_id: str = "doc_id",
    ids_encoding: str = "dictionary",
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Writes every row's ids, with ``end_id`` behind them, into Parquet files in ascending order of doc_id.

    Columns: doc_id, part (number of the file's range), row (place in it), before (ids of the
    rows before it in the range), n_tokens (with the end id), ids. Ids above 2^31 - 1 would not
    fit. Null and empty texts have the end id alone. Null doc_ids come last; rows
    that repeat a doc_id stand in the order of a hash of their texts; equal rows stand side by
    side. An empty table gives files without rows. Other columns are not read.

    Scale: one shuffle of the texts into ranges of about FILE_BYTES, cut by doc_id, text hash and
    row, so that one id with a third of all rows fills many ranges; a text is encoded once, after
    it. A task streams its range, STRETCH bytes of text at a time, and holds the ids of twice KEPT_PIECES pieces.
    """
    if ids_encoding not in ("dictionary", "delta"):
        raise ValueError("ids_encoding is 'dictionary' or 'delta'")
    spark = docs.sparkSession
    content = read_vocabulary(tokenizer_path)
    key = str(zlib.crc32(content.encode()))
    vocabulary = spark.sparkContext.broadcast(content)
    rows = named(docs, {"doc_id": doc_id, "_text": text}).withColumns(
        {"_text": whole_text("_text"), "_copy": F.monotonically_increasing_id()}
    )
    rows = rows.withColumn("_tag", F.xxhash64("_text"))
    size, known = source_bytes(docs)
    least = max(spark.sparkContext.defaultParallelism, 1 if known else int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("doc_id").asc_nulls_last(), F.col("_tag"), F.col("_copy")]
    ranged = rows.repartitionByRange(max(least, size // FILE_BYTES + 1), *order).sortWithinPartitions(*order)
    made = ranged.select("doc_id", "_text").mapInArrow(
        _rows(vocabulary, key, end_id),
        f"doc_id {dict(rows.dtypes)['doc_id']}, part int, row long, before long, n_tokens long, ids array<int>",
    )
    writer = made.write.mode("errorifexists")
    options = {
        # Format 2: deltas for integers that have no dictionary, levels apart from the values.
        "parquet.writer.version": "v2",
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": str(ids_encoding == "dictionary").lower(),
        # A dictionary may hold the ids of any usual vocabulary.
        "parquet.dictionary.page.size": str(4 << 20),
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.columnindex.truncate.length": "64",
        "compression": "zstd",
    }
    for name, value in options.items():
        writer = writer.option(name, value)
    writer.parquet(path)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, row, start (ids of all rows before it) and n_tokens of every row, without reading a token."""
    rows = spark.read.parquet(path).select("doc_id", "part", "row", "before", "n_tokens")
    return _with_start(rows, rows).drop("before")


def _with_start(rows: DataFrame, every: DataFrame) -> DataFrame:
    """The ids of the ranges before are one number for each range: a table of as many rows as there are files."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = every.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    bases = sums.select("part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    # One row per file of some megabytes: at most a few million, sixteen bytes each.
    return rows.join(F.broadcast(bases), "part").withColumn("start", F.col("_base") + F.col("before")).drop("_base")


def read(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Documents as written: doc_id, part, row, start, n_tokens, ids. ``where`` is a condition on
    doc_id, part, row or n_tokens, by which files, row groups and pages are left unread."""
    every = spark.read.parquet(path)
    rows = every if where is None else every.filter(where)
    return _with_start(rows, every.select("part", "n_tokens")).drop("before")


def checksums(tokens: DataFrame, ids: str = "ids", out: str = "ids_crc32") -> DataFrame:
    """The rows with the crc32 of their ids as little-endian unsigned 32-bit integers in place of the ids (null: of none)."""
    kept = [c for c in tokens.columns if c != ids]

    def run(batches):
        for t in batches:
            lists = t[ids]
            values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")
            at, found = lists.offsets.to_numpy(), lists.is_valid().to_pylist()
            sums = [zlib.crc32(values[a:b]) if ok else 0 for a, b, ok in zip(at[:-1], at[1:], found)]
            yield pa.RecordBatch.from_arrays([*(t[c] for c in kept), pa.array(sums, pa.int64())], [*kept, out])

    kinds = dict(tokens.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in kept), f"`{out}` long"])
    return tokens.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{ids}`")).mapInArrow(run, schema)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4()}"


__all__ = ["PieceEncoder", "checksums", "fresh_path", "read", "starts", "write"]
