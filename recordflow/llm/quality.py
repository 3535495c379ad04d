"""Quality scores by a factorisation machine.

Inputs of a text are its hashed words, statistics of its structure and its
metadata, each statistic as one of a few intervals. Besides a weight, every input
has a short vector, and each pair of inputs adds the product of their vectors. By
the identity  sum over pairs = half of (square of the sum - sum of the squares)
a score takes time linear in the number of inputs.
"""

from __future__ import annotations

import math
import operator
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named

# Hashed words, length of the vectors, and how many labelled rows a model is fitted on at most.
WORD_INPUTS, FACTORS, SAMPLE = 1 << 14, 8, 6_000
# Upper ends of the intervals of a share.
SHARES = (0.0, 0.002, 0.005, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
INTERVALS = len(SHARES) + 1
UPPER, LOWER, DIGITS = (bytes(range(a, b)) for a, b in ((65, 91), (97, 123), (48, 58)))
STOPS, SYMBOLS = b".,;:?", b"#$%&*+/<=>@[\\]^_`{}~"
STATISTICS = (
    "upper", "lower", "digits", "stops", "symbols", "bars", "cries", "high", "same_as_last", "distinct", "most_frequent",
    "longest_run", "repeated_lines", "words_a_line", "word_length", "words", "declared_length", "declared_right",
)


def _size(n: float) -> float:
    """A count as a share, by its logarithm."""
    return min(1.0, math.log2(1 + n) / 20)


def statistics(text: str, words: list[str], counts: Counter, declared: int | None) -> list[float | None]:
    """Values from 0 to 1 in the order of STATISTICS; None where nothing is known."""
    data = text.encode()
    n, m = max(1, len(data)), max(1, len(words))

    def share(of: bytes) -> float:
        return (len(data) - len(data.translate(None, of))) / n

    lines = [x for x in text.split("\n") if x]
    same = list(map(operator.eq, words, words[1:]))
    run = longest = 0
    if any(same):
        for s in same:
            run = run + 1 if s else 0
            longest = max(longest, run)
    upper, lower = share(UPPER), share(LOWER)
    letters = max(upper + lower, 1 / n)
    return [
        upper / letters,
        lower,
        share(DIGITS),
        share(STOPS),
        share(SYMBOLS) * 2,
        share(b"|") * 4,
        share(b"!") * 4,
        share(bytes(range(128, 256))),
        sum(same) / m,
        len(counts) / m,
        max(counts.values(), default=0) / m,
        longest / m,
        1 - len(set(lines)) / max(1, len(lines)),
        _size(m / max(1, len(lines))),
        min(1.0, sum(map(len, words)) / m / 20),
        _size(len(words)),
        None if declared is None else _size(max(0, declared)),
        None if declared is None else float(declared == len(text)),
    ]


def inputs(text: str | None, declared: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of a text's inputs: words with a total length of one, each statistic with one."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    crc = zlib.crc32
    hashed = np.fromiter([crc(w.encode()) % WORD_INPUTS for w in counts], np.int64, len(counts))
    values = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    values /= max(1e-6, float(np.sqrt((values**2).sum())))
    found = [
        WORD_INPUTS + i * (INTERVALS + 1) + (INTERVALS if x is None else int(np.searchsorted(SHARES, x)))
        for i, x in enumerate(statistics(text, words, counts, declared))
    ]
    return np.concatenate([hashed, np.array(found, np.int64)]), np.concatenate([values, np.ones(len(found), np.float32)])


INPUTS = WORD_INPUTS + len(STATISTICS) * (INTERVALS + 1)


@dataclass
class Model:
    base: float
    weights: np.ndarray
    vectors: np.ndarray

    def sums(self, numbers: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Raw scores of several texts laid end to end, the sums of their vectors, and the vectors times the values."""
        scaled = self.vectors[numbers] * values[:, None]
        total = np.add.reduceat(scaled, starts)
        pairs = 0.5 * (total**2 - np.add.reduceat(scaled**2, starts)).sum(axis=1)
        return self.base + np.add.reduceat(self.weights[numbers] * values, starts) + pairs, total, scaled

    def scores(self, texts: list, declared: list) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        found = [inputs(t, d) for t, d in zip(texts, declared)]
        sizes = np.array([len(n) for n, _ in found])
        raw, _, _ = self.sums(
            np.concatenate([n for n, _ in found]), np.concatenate([v for _, v in found]), np.cumsum(sizes) - sizes
        )
        return 1 / (1 + np.exp(-np.clip(raw.astype(np.float64), -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], passes: int = 15, batch: int = 64, seed: int = 3) -> Model:
    """A model from (numbers, values, label) of a bounded sample, by stochastic descent with rates that shrink per input.

    Without rows, or with one label only, every score is the share of label 1 (a half without rows).
    """
    rng = np.random.default_rng(seed)
    share = (sum(y for _, _, y in rows) + 1) / (len(rows) + 2)
    model = Model(
        math.log(share / (1 - share)),
        np.zeros(INPUTS, np.float32),
        rng.normal(0, 0.05, (INPUTS, FACTORS)).astype(np.float32),
    )
    if len({y for _, _, y in rows}) < 2:
        model.vectors[:] = 0
        return model
    seen_w, seen_v = np.full(INPUTS, 1e-6, np.float32), np.full((INPUTS, FACTORS), 1e-6, np.float32)
    for at in range(passes):
        rate = 0.2 / (1 + at / 5)
        order = rng.permutation(len(rows))
        for i in range(0, len(order), batch):
            part = [rows[j] for j in order[i : i + batch]]
            sizes = np.array([len(n) for n, _, _ in part])
            numbers, values = (np.concatenate([x[c] for x in part]) for c in (0, 1))
            raw, total, scaled = model.sums(numbers, values, np.cumsum(sizes) - sizes)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - np.array([y for _, _, y in part])) / len(part)
            each = np.repeat(error, sizes).astype(np.float32) * values
            used, place = np.unique(numbers, return_inverse=True)
            grad_w = np.bincount(place, each, len(used)).astype(np.float32) + 1e-5 * model.weights[used]
            slopes = each[:, None] * (np.repeat(total, sizes, axis=0) - scaled)
            grad_v = np.stack([np.bincount(place, slopes[:, f], len(used)) for f in range(FACTORS)], axis=1).astype(np.float32)
            grad_v += 1e-4 * model.vectors[used]
            seen_w[used] += grad_w**2
            seen_v[used] += grad_v**2
            model.weights[used] -= rate * grad_w / np.sqrt(seen_w[used])
            model.vectors[used] -= 0.25 * rate * grad_v / np.sqrt(seen_v[used])
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are not learned from; a row without an id is not one of them."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    text: str = "text",
    doc_id: str = "doc_id",
    declared: str | None = "n_chars",
    sample: int = SAMPLE,
) -> Model:
    """A model from at most ``sample`` labelled rows that are not held out, drawn by a hash of their id.

    Labels other than 0 and 1 and rows without a document are left out; of several labels of
    an id the largest counts. ``declared`` is the metadata column, if the table has it.
    """
    known = named(labels, {"_id": doc_id, "_label": label}).filter("_label in (0, 1) and _id is not null")
    known = known.groupBy("_id").agg(F.max("_label").cast("int").alias("_label")).filter(~held_out("_id"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    meta = F.col(f"`{declared}`").cast("long") if declared in docs.columns else F.lit(None).cast("long")
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"), meta.alias("_declared"))

    def extract(batches):
        for t in batches:
            found = [inputs(x, d) for x, d in zip(t["_text"].to_pylist(), t["_declared"].to_pylist())]
            columns = [pa.array([a.astype(np.int32).tobytes() for a, _ in found], pa.binary())]
            columns += [pa.array([v.tobytes() for _, v in found], pa.binary())]
            yield pa.RecordBatch.from_arrays([t["_id"], *columns, t["_label"]], ["_id", "numbers", "values", "_label"])

    # The sample is bounded, so it is broadcast, and its inputs fit the driver. An id may repeat; one row of it counts.
    id_type = dict(rows.dtypes)["_id"]
    found = rows.join(F.broadcast(chosen), "_id").mapInArrow(
        extract, f"_id {id_type}, numbers binary, values binary, _label int"
    )
    one = found.groupBy("_id").agg(F.min(F.struct("numbers", "values", "_label")).alias("r")).orderBy("_id")
    return fit(
        [
            (np.frombuffer(r.r.numbers, np.int32).astype(np.int64), np.frombuffer(r.r["values"], np.float32), r.r._label)
            for r in one.collect()
        ]
    )


def _declared_of(t: pa.RecordBatch, declared: str | None) -> list:
    return t[declared].to_pylist() if declared in t.schema.names else [None] * t.num_rows


def score(
    docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id", declared: str | None = "n_chars"
) -> DataFrame:
    """Every row's score from the whole text: doc_id, held_out, score (0 to 1), predicted (1 from a half on).

    Null text counts as empty, and is scored from its structure alone. Repeated rows have equal
    scores. No shuffle: a task holds the model and some hundred texts.
    """
    meta = F.col(f"`{declared}`").cast("long") if declared in docs.columns else F.lit(None).cast("long")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"), meta.alias("_declared"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                t = batch.slice(at, 256)
                found = model.scores(t["_text"].to_pylist(), t["_declared"].to_pylist())
                yield pa.RecordBatch.from_arrays([t["doc_id"], pa.array(found)], ["doc_id", "score"])

    scored = rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def keep_good(docs: DataFrame, model: Model, text: str = "text", declared: str | None = "n_chars") -> DataFrame:
    """The rows predicted good, with all their columns."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                t = batch.slice(at, 256)
                yield t.filter(pa.array(model.scores(t[text].to_pylist(), _declared_of(t, declared)) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
