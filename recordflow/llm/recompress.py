"""Repeated word passages by recompression.

The words of a document are letters. In rounds, runs of one letter and pairs of
neighbouring letters are replaced by new letters. A pair is joined when a bit of
each name says so (first left, second right), so the choice depends on nothing
but the two names, and a name is a hash of what it stands for, the same in every
document without asking. Hence equal passages get equal letters inside, but for
some at their ends. For every letter the stretch of words that decided it is
kept: a passage holding that stretch holds the letter, wherever it stands.

Two Spark rounds use this. The first brings together the letters of all
documents and marks those that several documents have. A window can only repeat
if all letters it decides are marked. The second round brings
together the remaining windows, named by 128 bits of their words, and marks
those that start in a document with a smaller id.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named, whole_text

WINDOW = 13
# Rounds of joining pairs, and the most words a letter may stand for: short enough that nearly every window
# of 13 words decides a letter, long enough that few of them are shared by chance.
ROUNDS, LONGEST = 3, 4
# Text that one bucket of names, or one group of documents, is made from. Beyond so many buckets or groups
# they grow instead, since packing needs several entries for each: some 1.5 GB and 0.1 GB of text at 100 TB.
BUCKET_BYTES, GROUP_BYTES = 24 << 20, 4 << 20
MOST_BUCKETS, MOST_GROUPS = 1 << 16, 1 << 20
# Characters of documents worked on together; more where there are many buckets to pack for.
AT_ONCE, MOST_AT_ONCE = 3 << 20, 24 << 20

# What decides a letter at the end of a document is not within any window.
OUTSIDE, BEYOND = -1, np.iinfo(np.int64).max
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_names(words: list[bytes], seed: int = 0) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.fromiter([digest(w, seed) for w in words], np.uint64, len(words))


class Letters:
    """Letters of several documents, joined end to end: name, words [start, end), and the words [low, high) that decided it."""

    def __init__(self, names: np.ndarray, doc: np.ndarray):
        at = np.arange(len(names))
        self.name, self.doc = names, doc
        self.start, self.end, self.low, self.high = at, at + 1, at.copy(), at + 1

    def _take(self, keep: np.ndarray) -> None:
        for column in ("name", "doc", "start", "end", "low", "high"):
            setattr(self, column, getattr(self, column)[keep])

    def join_runs(self, longest: int) -> None:
        """A run of equal letters becomes one, if it stands for at most ``longest`` words.

        Every letter, in a run or alone, is decided by its run and a neighbour on each side.
        """
        if not len(self.name):
            return
        near = self.doc[1:] == self.doc[:-1]
        low = np.r_[OUTSIDE, np.where(near, self.low[:-1], OUTSIDE)]
        high = np.r_[np.where(near, self.high[1:], BEYOND), BEYOND]
        starts = np.flatnonzero(np.r_[True, ~near | (self.name[1:] != self.name[:-1])])
        length = np.diff(np.r_[starts, len(self.name)])
        self.low = np.repeat(np.minimum.reduceat(low, starts), length)
        self.high = np.repeat(np.maximum.reduceat(high, starts), length)
        short = (length > 1) & (self.end[starts + length - 1] - self.start[starts] <= longest)
        first = starts[short]
        self.name, self.end = self.name.copy(), self.end.copy()
        self.name[first] = mixed(self.name[first] * _B + length[short].astype(np.uint64))
        self.end[first] = self.end[first + length[short] - 1]
        inner = np.repeat(short, length)
        inner[starts] = False
        self._take(~inner)

    def join_pairs(self, turn: int, longest: int) -> None:
        """A left letter and the right letter after it become one, if that stands for at most ``longest`` words."""
        n = len(self.name)
        if n < 2:
            return
        is_left = (mixed(self.name ^ np.uint64(turn * 2 + 1)) & np.uint64(1)).astype(bool)
        near = self.doc[1:] == self.doc[:-1]
        fits = self.end[1:] - self.start[:-1] <= longest
        joined = near & fits & is_left[:-1] & ~is_left[1:]
        # A left letter is decided by itself and the next one, a right letter by itself and the one before.
        next_low = np.r_[np.where(near, self.low[1:], OUTSIDE), OUTSIDE]
        next_high = np.r_[np.where(near, self.high[1:], BEYOND), BEYOND]
        last_low = np.r_[OUTSIDE, np.where(near, self.low[:-1], OUTSIDE)]
        last_high = np.r_[BEYOND, np.where(near, self.high[:-1], BEYOND)]
        self.low = np.minimum(self.low, np.where(is_left, next_low, last_low))
        self.high = np.maximum(self.high, np.where(is_left, next_high, last_high))
        at = np.flatnonzero(joined)
        self.name = self.name.copy()
        self.name[at] = mixed(self.name[at] * _A + mixed(self.name[at + 1] + _B))
        self.end = self.end.copy()
        self.end[at] = self.end[at + 1]
        keep = np.ones(n, bool)
        keep[at + 1] = False
        self._take(keep)


def recompressed(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS, longest: int = LONGEST) -> Letters:
    letters = Letters(names, doc)
    letters.join_runs(longest)
    for turn in range(rounds):
        letters.join_pairs(turn, longest)
    return letters


def decided(letters: Letters, names: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Letters that some window decides, and a name for each stretch that decided one."""
    of = np.flatnonzero((letters.low >= 0) & (letters.high - letters.low <= window))
    low, high = letters.low[of], letters.high[of]
    name = letters.name[of]
    for step in range(int((high - low).max()) if len(of) else 0):
        inside = low + step < high
        word = names[np.minimum(low + step, len(names) - 1)]
        name = np.where(inside, mixed(name * _A + word), name)
    return of, name


def windows_that_may_repeat(
    letters: Letters, of: np.ndarray, marked: np.ndarray, doc: np.ndarray, window: int
) -> np.ndarray:
    """Starts of windows none of whose decided letters is unmarked."""
    n = len(doc)
    if n < window:
        return np.zeros(0, np.int64)
    # A window [i, i + window) holds an unmarked stretch [low, high) if high - window <= i <= low.
    low, high = letters.low[of][~marked], letters.high[of][~marked]
    begun = np.bincount(np.maximum(high - window, 0), minlength=n + 1)
    held = np.cumsum(begun - np.bincount(low + 1, minlength=n + 1))[: n - window + 1]
    return np.flatnonzero((doc[: n - window + 1] == doc[window - 1 :]) & (held == 0))


def window_names(words: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    name = np.zeros(len(starts), np.uint64)
    for step in range(window):
        name = mixed(name * _A + words[starts + step] + _B)
    return name


# Entries: what is sent to a bucket of names, and what comes back to a group of documents, as packed arrays.


def _halves(a: np.ndarray) -> bytes:
    """Numbers by their 16-bit parts, so that zeros compress away."""
    return np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint16).reshape(len(a), -1).T).tobytes()


def packed(**arrays: np.ndarray) -> bytes:
    """Entries (id, tag, place and names) as bytes: each document once, with the number of its entries."""
    order = np.lexsort((arrays["place"], arrays["tag"], arrays["id"]))
    id_, tag = arrays["id"][order], arrays["tag"][order]
    new = np.flatnonzero(np.r_[len(id_) > 0, (id_[1:] != id_[:-1]) | (tag[1:] != tag[:-1])])
    counts = np.diff(np.r_[new, len(id_)]).astype(np.uint32)
    out = [np.array([len(id_), len(new)], np.int64).tobytes(), _halves(id_[new]), _halves(tag[new]), _halves(counts)]
    for name, a in arrays.items():
        if name not in ("id", "tag"):
            out.append(a[order].tobytes() if a.dtype == np.uint64 else _halves(a[order]))
    return b"".join(out)


def unpacked(data: bytes, **kinds: type) -> dict[str, np.ndarray]:
    at = 16

    def read(kind: type, n: int) -> np.ndarray:
        nonlocal at
        size = n * np.dtype(kind).itemsize
        part, at = data[at : at + size], at + size
        if kind is np.uint64:
            return np.frombuffer(part, np.uint64)
        return np.ascontiguousarray(np.frombuffer(part, np.uint16).reshape(-1, n).T).view(kind).reshape(n)

    n, documents = np.frombuffer(data, np.int64, 2).tolist()
    id_, tag, counts = read(np.int64, documents), read(np.uint32, documents), read(np.uint32, documents)
    out = {name: read(kind, n) for name, kind in kinds.items() if name not in ("id", "tag")}
    return out | {"id": np.repeat(id_, counts), "tag": np.repeat(tag, counts)}


# Names in a bucket: of letters 32 further bits (a chance agreement only costs a comparison in the
# second round), of windows 96 bits of their words.
OF_LETTERS = {"name": np.uint32, "id": np.int64, "tag": np.uint32, "place": np.uint32}
OF_WINDOWS = {"name": np.uint64, "check": np.uint32, "id": np.int64, "tag": np.uint32, "place": np.uint32}
MARK = {"id": np.int64, "tag": np.uint32, "place": np.uint32}


def _least_only(e: dict[str, np.ndarray]) -> tuple[dict, dict]:
    """Entries with the smallest id of their name, and marks: windows of a larger id, letters of a name with several ids."""
    keys = [c for c in ("check", "name") if c in e]
    order = np.lexsort((e["id"], *(e[c] for c in keys)))
    changed = np.zeros(max(0, len(order) - 1), bool)
    for c in keys:
        column = e[c][order]
        changed |= column[1:] != column[:-1]
    id_ = e["id"][order]
    new = np.r_[True, changed]
    heads, of = np.flatnonzero(new), np.cumsum(new) - 1
    larger = id_ > id_[heads][of]
    known = larger
    if "check" not in e and len(heads):
        # The first document of a passage must send its windows too, for the others to be compared with.
        known = np.logical_or.reduceat(larger, heads)[of]
    return {c: a[order[~larger]] for c, a in e.items()}, {c: e[c][order[known]] for c in MARK}


def _grouped(keys: np.ndarray, arrays: dict[str, np.ndarray]) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    cuts = np.r_[0, np.flatnonzero(np.diff(keys)) + 1, len(keys)] if len(keys) else np.zeros(1, int)
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(keys[a]), packed(**{c: v[order[a:b]] for c, v in arrays.items()})


def _spread(ids: np.ndarray, tags: np.ndarray, groups: int) -> np.ndarray:
    """Group of a document, as ``_part`` has it."""
    return np.mod(ids ^ (tags.astype(np.int64) << 17), groups)


def _part(groups: int):
    return F.pmod(F.col("_id").bitwiseXOR(F.shiftleft(F.crc32("_text"), 17)), F.lit(groups))


# Rows between the steps: entries go to a bucket of names; marks that are already known to a group of documents.
ROUTED = pa.schema([("bucket", pa.int64()), ("marks_of", pa.int64()), ("data", pa.binary())])
ROUTED_DDL = "bucket long, marks_of long, data binary"


def _routed(e: dict[str, np.ndarray], kind: dict[str, type], buckets: int, groups: int) -> Iterator[pa.RecordBatch]:
    """What is sent on for some documents: of each name the entries of the smallest id, and the marks found among them."""
    if not len(e["name"]):
        return
    rest, known = _least_only(e)
    bucket = (rest["name"] % np.uint64(buckets)).astype(np.int64)
    rest["name"] = (rest["name"] // np.uint64(buckets)).astype(kind["name"])
    rows = [(b, None, data) for b, data in _grouped(bucket, {c: rest[c] for c in kind})]
    rows += [(g % buckets, g, data) for g, data in _grouped(_spread(known["id"], known["tag"], groups), known)]
    yield pa.RecordBatch.from_pydict(dict(zip(ROUTED.names, map(list, zip(*rows)))), schema=ROUTED)


class Batch:
    """Some documents with their words joined end to end."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.words: list[bytes] = []
        sizes = []
        for text in texts:
            words = text.encode().split()
            sizes.append(len(words))
            self.words += words
        self.ids = np.array(ids, np.int64)
        self.tags = np.array([zlib.crc32(t.encode()) for t in texts], np.uint32)
        self.sizes = np.array(sizes, np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)
        self.names = word_names(self.words)

    def letters(self, window: int) -> tuple[Letters, np.ndarray, np.ndarray]:
        letters = recompressed(self.names, self.doc)
        return letters, *decided(letters, self.names, window)

    def entries(self, word: np.ndarray, **names: np.ndarray) -> dict[str, np.ndarray]:
        """Entries for names that begin at ``word``; its place in the document comes back with the mark."""
        doc = self.doc[word]
        place = (word - self.first[doc]).astype(np.uint32)
        return {**names, "id": self.ids[doc], "tag": self.tags[doc], "place": place}

    def marked(self, marks: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Documents and places of the marks that are of these documents."""
        if not len(marks["id"]) or not len(self.ids):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        kind = np.dtype([("id", np.int64), ("tag", np.uint32)])
        own, given = np.empty(len(self.ids), kind), np.empty(len(marks["id"]), kind)
        own["id"], own["tag"] = self.ids, self.tags
        given["id"], given["tag"] = marks["id"], marks["tag"]
        docs, places = [], []
        # Rows that repeat an id and a text are several documents with the same marks.
        order = np.argsort(given, order=("id", "tag"), kind="stable")
        given = given[order]
        left, right = np.searchsorted(given, own, "left"), np.searchsorted(given, own, "right")
        for d in np.flatnonzero(right > left):
            found = marks["place"][order[left[d] : right[d]]]
            docs.append(np.full(len(found), d))
            places.append(found.astype(np.int64))
        return (np.concatenate(docs), np.concatenate(places)) if docs else (np.zeros(0, np.int64),) * 2


def _batches(batches: Iterator[pa.RecordBatch], at_once: int = AT_ONCE) -> Iterator[Batch]:
    """Documents in batches of some characters, at least one document each."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch["_id"].to_pylist(), batch["_text"].to_pylist()):
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size >= at_once:
                yield Batch(ids, texts)
                ids, texts, size = [], [], 0
    if ids:
        yield Batch(ids, texts)


def _send_letters(window: int, buckets: int, groups: int):
    def run(batches):
        for b in _batches(batches, min(MOST_AT_ONCE, max(AT_ONCE, 256 * buckets))):
            letters, of, name = b.letters(window)
            yield from _routed(b.entries(letters.low[of], name=name), OF_LETTERS, buckets, groups)

    return run


def _resolve(kind: dict[str, type], groups: int):
    """Marks of one bucket, and those known before."""

    def run(key, table):
        parts, out = [], []
        for known, data in zip(table["marks_of"].to_pylist(), table["data"].to_pylist()):
            if known is None:
                parts.append(unpacked(data, **kind))
            else:
                out.append((known, data))
        if parts:
            _, found = _least_only({c: np.concatenate([p[c] for p in parts]) for c in kind})
            out += list(_grouped(_spread(found["id"], found["tag"], groups), found))
        columns = [pa.array([g for g, _ in out], pa.int64()), pa.array([d for _, d in out], pa.binary())]
        return pa.table(columns, ["part", "data"])

    return run


def _all_marks(table: pa.Table) -> dict[str, np.ndarray]:
    parts = [unpacked(x, **MARK) for x in table["data"].to_pylist()]
    return {c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, k) for c, k in MARK.items()}


def _send_windows(window: int, buckets: int, groups: int):
    def run(key, docs, marks):
        marks = _all_marks(marks)
        sent = []
        for b in _batches(docs.to_batches()):
            letters, of, _ = b.letters(window)
            low = letters.low[of]
            at = np.zeros(len(b.doc) + 1, bool)
            doc, place = b.marked(marks)
            at[b.first[doc] + place] = True
            starts = windows_that_may_repeat(letters, of, at[low], b.doc, window)
            if not len(starts):
                continue
            # A second, independent name for the words of these windows.
            needed = np.flatnonzero(covered(len(b.words), starts, window))
            second = np.zeros(len(b.words), np.uint64)
            second[needed] = word_names([b.words[i] for i in needed.tolist()], 1)
            check = (window_names(second, starts, window) >> np.uint64(32)).astype(np.uint32)
            e = b.entries(starts, name=window_names(b.names, starts, window), check=check)
            sent += list(_routed(e, OF_WINDOWS, buckets, groups))
        return pa.Table.from_batches(sent, ROUTED)

    return run


def covered(size: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which words the windows that begin at ``starts`` cover."""
    begun = np.bincount(starts, minlength=size + 1)
    return np.cumsum(begun - np.bincount(starts + window, minlength=size + 1))[:size] > 0


def _remove(window: int, keep_text: bool):
    def run(key, docs, marks):
        marks = _all_marks(marks)
        out: dict[str, list] = {"_id": [], "n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
        for b in _batches(docs.to_batches()):
            doc, place = b.marked(marks)
            gone = covered(len(b.words), b.first[doc] + place, window)
            for d, (first, size) in enumerate(zip(b.first.tolist(), b.sizes.tolist())):
                cut = gone[first : first + size]
                kept = [b.words[first + i] for i in np.flatnonzero(~cut).tolist()] if cut.any() else b.words[first : first + size]
                text = b" ".join(kept)
                out["_id"].append(int(b.ids[d]))
                out["n_words"].append(size)
                out["n_removed"].append(int(cut.sum()))
                out["kept_sha256"].append(hashlib.sha256(text).hexdigest())
                out["kept_text"].append(text.decode() if keep_text else None)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds)})

    return run


NULL_ID = (1 << 63) - 1


def without_repeats(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, keep_text: bool = False
) -> DataFrame:
    """Every row without the words of windows that also start in a document with a smaller id.

    Returns doc_id (an integer), n_words, n_removed, kept_sha256, and with ``keep_text`` kept_text: the words
    left, joined by one space. A word is what stands between blanks; null text has
    none. Windows are judged on the input. Repeats within one document stay, and so do
    rows that repeat an id. A null id counts as larger than all others (and as the id
    2^63 - 1). An empty table gives an empty result. Other columns are not read.

    Scale: text moves once, by document; letters and windows move as packed names. Of each
    name a task sends on the smallest id only, so a passage that most documents hold
    is a few entries. Buckets and groups grow in number with the text, not in size.
    """
    rows = named(docs, {"_id": doc_id, "_text": text}).select(
        F.coalesce(F.col("_id").cast("long"), F.lit(NULL_ID)).alias("_id"), whole_text("_text").alias("_text")
    )
    total = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    buckets = min(MOST_BUCKETS, int(total // BUCKET_BYTES) + 1)
    groups = min(MOST_GROUPS, int(total // GROUP_BYTES) + 1)
    # Read by both cogroups below, and shuffled once.
    by_part = rows.withColumn("part", _part(groups)).groupBy("part")
    marks_ddl = "part long, data binary"
    letters = rows.mapInArrow(_send_letters(window, buckets, groups), ROUTED_DDL)
    marked = letters.groupBy("bucket").applyInArrow(_resolve(OF_LETTERS, groups), marks_ddl)
    windows = by_part.cogroup(marked.groupBy("part")).applyInArrow(_send_windows(window, buckets, groups), ROUTED_DDL)
    repeated = windows.groupBy("bucket").applyInArrow(_resolve(OF_WINDOWS, groups), marks_ddl)
    result = by_part.cogroup(repeated.groupBy("part")).applyInArrow(
        _remove(window, keep_text), "_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
    columns = ["n_words", "n_removed", "kept_sha256", *(["kept_text"] if keep_text else [])]
    return result.select(F.when(F.col("_id") != NULL_ID, F.col("_id")).alias("doc_id"), *columns)
