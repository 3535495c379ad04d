"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, for every place, the hash of all before it:
sum of c[j] * B^j modulo 2^31 - 1, for two bases B. The hash of any span is the
difference of two entries, freed from its place by a power of 1/B, so spans of
any texts are compared in constant time, and the longest common extension of two
places is found by binary search. Texts are laid end to end, so that one pair of arrays
serves many of them. A fingerprint holds the length, the hash of the whole text, and the
least of the mixed hashes of all its spans of one width, where a text counts as standing
between marks, so that texts shorter than a span have spans too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.operators.staging import materialise

from .common import named, running_total, whole_text

P = (1 << 31) - 1
BASES = (1_000_003, 2_038_074_743)
BLOCK = 1 << 16
# Characters of a span, and how many least values a fingerprint keeps.
WIDTH, KEPT = 12, 64
# Bytes of text in a range of the order, the most ranges there are, and what a text counts for beside its bytes.
RANGE_BYTES = 16 << 20
MOST_RANGES = 200_000
ROW_BYTES = 64
# Characters and rows that a task looks at together.
STRETCH, STRETCH_ROWS = 1 << 18, 512
# Stands before and behind a text: a code point that is no character.
MARK = "\U0010ffff"
_P = np.uint64(P)
_31 = np.uint64(31)
_FULL = 1 << 32


def _fold(x: np.ndarray) -> np.ndarray:
    """A smaller number that is the same modulo P, by the binary form of x."""
    return (x & _P) + (x >> _31)


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo P for x below 2^63."""
    x = _fold(_fold(x))
    return np.where(x >= _P, x - _P, x)


# Powers of the bases and their inverses over a block, made once per process.
_made: dict[int, np.ndarray] = {}


def _powers(base: int) -> np.ndarray:
    if base not in _made:
        out, n = np.ones(1, np.uint64), 1
        while n < BLOCK:
            out = np.concatenate([out, _mod(out * np.uint64(pow(base, n, P)))])
            n *= 2
        _made[base] = out
    return _made[base]


def mixed(x: np.ndarray) -> np.ndarray:
    """32 well spread bits of each hash."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(32)


class Laid:
    """Texts end to end, with marks before, between and behind them, and their prefix arrays: eight bytes a character."""

    def __init__(self, texts: list[str], marks: int = 0):
        self.marks = marks
        codes = np.frombuffer((MARK * marks).join(["", *texts, ""]).encode("utf-32-le"), np.uint32)
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        # Where each text begins; its spans begin up to ``marks`` earlier, and up to its last character.
        self.starts = np.cumsum(self.lengths + marks) - self.lengths
        self.size = len(codes)
        self.arrays = []
        for base in BASES:
            sums, low = np.zeros(self.size + 1, np.uint32), _powers(base)
            for at in range(0, self.size, BLOCK):
                part = codes[at : at + BLOCK].astype(np.uint64) + np.uint64(1)
                inner = np.cumsum(_fold(part * low[: len(part)]))
                if at:
                    inner = _fold(_fold(inner) * np.uint64(pow(base, at, P))) + np.uint64(sums[at])
                sums[at + 1 : at + 1 + len(part)] = _mod(inner)
            self.arrays.append(sums)

    def _power(self, base: int, at: np.ndarray) -> np.ndarray:
        high = np.array([pow(base, k * BLOCK, P) for k in range(self.size // BLOCK + 1)], np.uint64)
        return _mod(_powers(base)[at % BLOCK] * high[at // BLOCK])

    def blocks(self, width: int, begin: int = 0, end: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """Mixed hashes of all spans of a width that begin from ``begin`` to before ``end``, a block at a time."""
        last = self.size - width + 1 if end is None else min(end, self.size - width + 1)
        for at in range(begin - begin % BLOCK, max(0, last), BLOCK):
            low, high = max(at, begin), min(at + BLOCK, last)
            both = []
            for base, h in zip(BASES, self.arrays):
                ahead = h[low + width : high + width].astype(np.uint64) + _P - h[low:high]
                placed = _fold(ahead * _powers(pow(base, -1, P))[low - at : high - at])
                both.append(_mod(_fold(placed) * np.uint64(pow(base, -at, P)) if at else placed))
            yield low, mixed((both[0] << _31) | both[1])

    def wholes(self) -> list[tuple[int, ...]]:
        """Hash of each text, the same wherever it stands."""
        found = []
        for base, h in zip(BASES, self.arrays):
            ahead = h[self.starts + self.lengths].astype(np.uint64) + _P - h[self.starts]
            found.append(_mod(_mod(ahead) * self._power(pow(base, -1, P), self.starts)).tolist())
        return list(zip(*found))

    def sketches(self, kept: int) -> list[np.ndarray]:
        """The ``kept`` least distinct values of each text's spans of marks + 1 characters, in ascending order."""
        width, counts = self.marks + 1, self.lengths + self.marks
        edges = np.append(0, np.cumsum(counts))
        # Of long texts only values that can be among the least are sorted; some are too few where spans repeat.
        bounds = np.minimum(_FULL, 6 * kept * _FULL // np.maximum(counts, 1)).astype(np.uint64)
        keys = [np.empty(0, np.uint64)]
        for at, values in self.blocks(width):
            first, last = np.searchsorted(edges, [at, at + len(values) - 1], "right") - 1
            of = np.arange(first, last + 1)
            inside = np.minimum(edges[of + 1], at + len(values)) - np.maximum(edges[of], at)
            owner = np.repeat(of, inside)
            few = np.flatnonzero(values < np.repeat(bounds[of], inside))
            keys.append((owner[few].astype(np.uint64) << np.uint64(32)) | values[few])
        found = np.unique(np.concatenate(keys))
        at = np.searchsorted(found >> np.uint64(32), np.arange(len(counts) + 1, dtype=np.uint64))
        out = []
        for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            if b - a < kept and bounds[i] < _FULL:
                out.append(self._least(width, int(edges[i]), int(edges[i + 1]), kept))
            else:
                out.append((found[a : min(b, a + kept)] & np.uint64(_FULL - 1)).astype(np.uint32))
        return out

    def _least(self, width: int, begin: int, end: int, kept: int) -> np.ndarray:
        found = np.empty(0, np.uint64)
        for _, values in self.blocks(width, begin, end):
            found = np.unique(np.concatenate([found, values]))[:kept]
        return found.astype(np.uint32)

    def common_starts(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many characters from the start each of some texts shares with another, by binary search for all at once."""
        a, b = self.starts[one], self.starts[other]
        low, high = np.zeros(len(a), np.int64), np.minimum(self.lengths[one], self.lengths[other])
        powers = [(h, self._power(base, a), self._power(base, b)) for base, h in zip(BASES, self.arrays)]
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = np.ones(len(a), bool)
            for h, of_a, of_b in powers:
                left, right = (_mod(h[s + middle].astype(np.uint64) + _P - h[s]) for s in (a, b))
                equal &= _mod(left * of_b) == _mod(right * of_a)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low


class Prefixes(Laid):
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        super().__init__([text])
        self.n = self.size

    def span(self, start: int, end: int) -> tuple[int, ...]:
        """Hash of a span, the same wherever its characters stand."""
        return tuple(
            (int(h[end]) - int(h[start])) * pow(base, -start, P) % P for base, h in zip(BASES, self.arrays)
        )

    def spans(self, width: int) -> np.ndarray:
        """Mixed hashes of all spans of a width."""
        return np.concatenate([np.empty(0, np.uint64), *(v for _, v in self.blocks(width))])


def span_equal(a: Prefixes, i: int, b: Prefixes, j: int, length: int) -> bool:
    return length == 0 or a.span(i, i + length) == b.span(j, j + length)


def longest_common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """How many characters from place i of one text equal those from place j of another."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if span_equal(a, i, b, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def written(n: int, text_hash: tuple[int, ...], sketch: np.ndarray) -> str:
    """Length, hash of the whole and sketch, in hex."""
    return f"{n:x}.{text_hash[0]:08x}{text_hash[1]:08x}.{sketch.astype('>u4').tobytes().hex()}"


def prints(texts: list[str], width: int = WIDTH, kept: int = KEPT) -> tuple[list[str], Laid]:
    """Fingerprints of texts, and their prefix arrays."""
    laid = Laid(texts, width - 1)
    return [written(*x) for x in zip(laid.lengths.tolist(), laid.wholes(), laid.sketches(kept))], laid


def likeness(one: str, other: str, kept: int = KEPT) -> float:
    """Twice the common share of two texts' distinct spans over the sum of both, estimated from the least values.

    It is exact where both have at most ``kept`` spans together. Spans are of one width for all lengths; a
    text of n characters has n + width - 1, those at its ends with marks, so it is like its
    first half even where that is shorter than a span. The empty text is like itself alone.
    """
    (n1, h1, s1), (n2, h2, s2) = one.split("."), other.split(".")
    if (n1, h1) == (n2, h2):
        return 1.0
    a, b = ({s[i : i + 8] for i in range(0, len(s), 8)} for s in (s1, s2))
    seen = sorted(a | b)[:kept]
    if not seen or "0" in (n1, n2):
        return 0.0
    both = a & b
    share = sum(v in both for v in seen) / len(seen)
    return 2 * share / (1 + share)


def _compared(rows: list[tuple], width: int, kept: int) -> list[tuple]:
    """Results of rows (doc_id, text, range, copy) that come in order: of all that another row of their range follows."""
    of = [i for i in range(len(rows) - 1) if not rows[i][3]]
    if any(rows[i][2] != rows[i + 1][2] for i in of):
        raise ValueError("a range ends without the row that follows it")
    texts = [r[1] for r in rows]
    halves = [(len(texts[i]) // 2, i) for i in of]
    edited = [texts[i][: len(texts[i]) - half] + texts[i + 1][:half] for half, i in halves]
    found, laid = prints(texts + edited, width, kept)
    here, made = np.array(of, np.int64), np.arange(len(texts), len(texts) + len(of))
    shared, ahead = laid.common_starts(here, made), laid.common_starts(here, here + 1)
    return [
        (
            rows[i][0],
            len(texts[i]),
            hashlib.sha256(edited[k].encode()).hexdigest(),
            found[i],
            found[len(texts) + k],
            likeness(found[i], found[len(texts) + k], kept),
            likeness(found[i], found[i + 1], kept),
            int(shared[k]),
            int(ahead[k]),
        )
        for k, i in enumerate(of)
    ]


def _pairs(width: int, kept: int):
    """Rows come in order, each range ending with a copy of the row that follows it."""

    def run(batches):
        kinds, held, size = None, [], 0

        def made():
            out = _compared(held, width, kept) if len(held) > 1 else []
            del held[: -1 if not held[-1][3] else None]  # the last row waits for the next, a copy for none
            if out:
                yield pa.RecordBatch.from_pydict({n: pa.array(v, k) for (n, k), v in zip(kinds.items(), zip(*out))})

        for batch in batches:
            kinds = _columns(batch)
            for start in range(0, batch.num_rows, 64):
                t = batch.slice(start, 64)
                for row in zip(*(t[c].to_pylist() for c in ("doc_id", "_text", "_range", "_copy"))):
                    held.append(row)
                    size += len(row[1])
                    if size >= STRETCH or len(held) >= STRETCH_ROWS:
                        yield from made()
                        size = sum(len(r[1]) for r in held)
        if held:
            yield from made()

    return run


def _columns(t: pa.RecordBatch) -> dict:
    kinds = {"n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string()}
    kinds |= {"edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}
    return {"doc_id": t.schema.field("doc_id").type} | kinds | {"common_edited": pa.int64(), "common_next": pa.int64()}


ORDER = ["_last", "_down", "_tag", "_copy_of"]


def fingerprints(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, kept: int = KEPT
) -> DataFrame:
    """Every row's fingerprint, and that of the row edited with the start of the next one.

    Returns doc_id (an integer), n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, and common_edited, common_next: how far the text and the other agree from the start.
    The edited text is the text whose last floor(n/2) characters became the first as many of the
    next row. Rows are in descending doc_id, null ones last, equal ids by a hash of the
    text, equal rows side by side; after the last comes the first. Null text is empty; the empty text
    is like itself and unlike others. Equal texts have equal fingerprints. A single row
    follows itself; an empty table gives an empty result.

    Scale: texts move once, to ranges of the order of RANGE_BYTES (more where there would be more than MOST_RANGES),
    each a partition of its own, which are read as streams; the first row of a range also goes to the end
    of the range before. Ranges are cut by bytes at any row, so that an id with a third of all rows fills many. A
    task holds STRETCH characters with their prefix arrays, or one text, however long a range is.
    """
    spark = docs.sparkSession
    rows = named(docs, {"doc_id": doc_id, "_text": text}).select(
        F.col("doc_id").cast("long"), whole_text("_text").alias("_text")
    )
    # The order of descending ids that cannot overflow.
    order = rows.withColumns(
        {
            "_last": F.col("doc_id").isNull(),
            "_down": F.coalesce(F.bitwise_not("doc_id"), F.lit(0)),
            "_tag": F.xxhash64("_text"),
            "_copy_of": F.monotonically_increasing_id(),
        }
    )
    sizes = materialise(order.select(F.lit(0).alias("_all"), *ORDER, (F.octet_length("_text") + ROW_BYTES).cast("long").alias("_size")))
    total = sizes.agg(F.sum("_size")).first()[0] or 0
    length = max(RANGE_BYTES, -(-total // MOST_RANGES))
    placed = running_total(sizes, ["_all"], ORDER, "_size", "_before").withColumn("_range", F.floor(F.col("_before") / length))
    # One row for each range: where it begins.
    tops = placed.groupBy("_range").agg(F.min(F.struct(*ORDER)).alias("top")).orderBy("_range").collect()
    tops = [tuple(r.top) for r in tops]
    ranges = max(1, len(tops))

    def range_of(last: pd.Series, down: pd.Series, tag: pd.Series, copy: pd.Series) -> pd.Series:
        """Ranges of rows: by the id alone where no range begins within it."""
        from bisect import bisect_right

        known = np.array([t[1] for t in tops if not t[0]], np.int64)
        out = np.searchsorted(known, down.to_numpy(), "right") - 1
        unsure = last.to_numpy() | np.isin(down.to_numpy(), known)
        for i in np.flatnonzero(unsure).tolist():
            out[i] = bisect_right(tops, (bool(last[i]), int(down[i]), int(tag[i]), int(copy[i]))) - 1
        return pd.Series(out, dtype="int64")

    placing = F.pandas_udf(range_of, "long")
    order = order.withColumn("_range", placing(*[F.col(c) for c in ORDER]))
    # The first row of each range also ends the range before, that of the first range the last.
    follows = [(i, *t, (i - 1) % ranges) for i, t in enumerate(tops)]
    first = spark.createDataFrame(follows, "_range long, _t0 boolean, _t1 long, _t2 long, _t3 long, _ends long")
    is_top = (F.col("_last") == F.col("_t0")) & (F.col("_down") == F.col("_t1")) & (F.col("_tag") == F.col("_t2")) & (F.col("_copy_of") == F.col("_t3"))
    own = F.struct(F.col("_range"), F.lit(False).alias("_copy"))
    ending = F.struct(F.col("_ends").alias("_range"), F.lit(True).alias("_copy"))
    places = F.when(is_top, F.array(own, ending)).otherwise(F.array(own))
    dealt = (
        order.join(F.broadcast(first), "_range")
        .select("doc_id", "_text", *ORDER, F.explode(places).alias("_place"))
        .select("doc_id", "_text", *ORDER, "_place._range", "_place._copy")
        .repartitionById(ranges, F.col("_range").cast("int"))
        .sortWithinPartitions("_range", "_copy", *ORDER)
        .select("doc_id", "_text", "_range", "_copy")
    )
    return dealt.mapInArrow(
        _pairs(width, kept),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, common_edited long, common_next long",
    )
