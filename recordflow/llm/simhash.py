"""SimHash near duplicates by covering locality-sensitive hashing.

For radius r every bit position gets a vector of r + 1 bits. Each of the
2^(r+1) - 1 nonzero vectors v makes one table: its mask keeps the positions whose
vector has an odd product with v. The vectors of at most r differing positions
cannot span all r + 1 dimensions, so some v is orthogonal to all of them, and its
mask hides every difference: each pair within the radius meets in some table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_groups, keep_one, materialise, named, whole_text
from .components import components

BITS, RADIUS, SHINGLE, SEED = 64, 4, 4, 42
# Buckets with more distinct fingerprints than this are dealt out again by a second family of masks.
LARGE_BUCKET = 2_000
# Bytes of text whose words are held at once.
BLOCK = 1 << 20


def masks(radius: int = RADIUS, step: int = 1, bits: int = BITS) -> list[int]:
    """The masks of one covering family; another ``step`` deals the vectors to other positions."""
    n = (1 << (radius + 1)) - 1
    vectors = [(i * step % bits) % n + 1 for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def word_blocks(text: str, shingle: int, size: int = BLOCK) -> Iterator[list[bytes]]:
    """Lower-cased words in blocks; a block begins with the last words of the one before, so no shingle is cut."""
    data = text.encode().lower()
    held: list[bytes] = []
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        words = held + data[at:end].split()
        at = end
        if len(words) >= shingle or at >= len(data):
            yield words
            held = words[len(words) - shingle + 1 :] if shingle > 1 else []
        else:
            held = words


def shingle_hashes(text: str, shingle: int, seed: int) -> Iterator[np.ndarray]:
    import xxhash

    digest, first = xxhash.xxh64_intdigest, True
    for words in word_blocks(text, shingle):
        if len(words) < shingle:
            if first and words:
                yield np.array([digest(b" ".join(words), seed)], np.uint64)
            return
        first = False
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        ends = ends[shingle - 1 :].tolist()
        yield np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends)], np.uint64)


def simhash(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is set if over half of the shingle hashes have it; 0 for a text without words."""
    ones, total = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, shingle, seed):
        total += len(hashes)
        for at in range(0, len(hashes), 8192):
            part = hashes[at : at + 8192]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, seed: int = SEED
) -> DataFrame:
    """Every row's fingerprint as a signed 64-bit number: doc_id, fp, and _key, a hash of the text."""
    rows = named(docs, {"doc_id": doc_id, "_text": text}).select(
        "doc_id", whole_text("_text").alias("_text"), F.xxhash64(whole_text("_text")).alias("_key")
    )

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                t = batch.slice(at, 512)
                found = np.array([simhash(x.as_py(), shingle, seed) for x in t["_text"]], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([t["doc_id"], t["_key"], pa.array(found)], ["doc_id", "_key", "fp"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, _key long, fp long")


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links within the radius that connect all that links within it would connect. Memory: that of the values."""
    rest, links = values[1:], []
    waiting = [values[0]]
    while rest.size:
        if not waiting:
            waiting, rest = [rest[0]], rest[1:]
            continue
        here = waiting.pop()
        near = np.bitwise_count(rest ^ here) <= radius
        if near.any():
            found = rest[near]
            links.extend((int(here), int(x)) for x in found)
            waiting.extend(found)
            rest = rest[~near]
    return links


def _linked(radius: int):
    """Links within each run of equal buckets; rows come sorted by bucket."""

    def of_runs(bucket: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        starts, ends = np.r_[0, cuts], np.r_[cuts, len(bucket)]
        two = starts[ends - starts == 2]
        a, b = fp[two], fp[two + 1]
        near = np.bitwise_count(a ^ b) <= radius
        us, vs = [a[near].view(np.int64)], [b[near].view(np.int64)]
        for s, e in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
            if links := forest(fp[s:e], radius):
                pairs = np.array(links, np.uint64).view(np.int64)
                us.append(pairs[:, 0])
                vs.append(pairs[:, 1])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    def run(batches):
        bucket, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            bucket = np.concatenate([bucket, batch["bucket"].to_numpy()])
            fp = np.concatenate([fp, batch["fp"].to_numpy().view(np.uint64)])
            if not len(bucket) or bucket[0] == bucket[-1]:
                continue
            last = int(np.flatnonzero(np.diff(bucket))[-1]) + 1
            yield of_runs(bucket[:last], fp[:last])
            bucket, fp = bucket[last:], fp[last:]
        if len(bucket):
            yield of_runs(bucket, fp)

    return run


def _in_tables(rows: DataFrame, family: list[int], *within: str) -> DataFrame:
    """A row per table: its bucket (a hash: buckets that collide only cost comparisons) and how many share it."""

    def bucket(t: int, mask: int) -> Column:
        return F.xxhash64(*within, F.lit(t), F.col("fp").bitwiseAND(F.lit(_signed(mask))))

    tables = rows.select("fp", F.explode(F.array(*[bucket(t, m) for t, m in enumerate(family)])).alias("bucket"))
    alike = Window.partitionBy("bucket")
    return tables.withColumn("_in", F.count(F.lit(1)).over(alike)).filter("_in > 1")


def links(distinct: DataFrame, radius: int = RADIUS, large: int = LARGE_BUCKET) -> DataFrame:
    """(u, v) of distinct ``fp`` within the radius: enough of them to connect all that are linked.

    A bucket holds fingerprints that agree on a mask. Larger ones are dealt out by the
    masks of a second family, which again hide any difference within the radius; a
    bucket of both fixes three quarters of the bits, so it holds some 2^16 values at most.
    """
    found = _in_tables(distinct, masks(radius))
    small, big = found.filter(F.col("_in") <= large), found.filter(F.col("_in") > large)
    again = _in_tables(big.select("fp", "bucket"), masks(radius, step=19), "bucket")
    pairs = [
        x.sortWithinPartitions("bucket").select("bucket", "fp").mapInArrow(_linked(radius), "u long, v long")
        for x in (small, again)
    ]
    return pairs[0].unionByName(pairs[1]).distinct()


def near_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    radius: int = RADIUS,
    shingle: int = SHINGLE,
    seed: int = SEED,
) -> DataFrame:
    """Every row with its class: doc_id, fingerprint, component_id, and _key, _stays for ``drop_near``.

    Texts whose fingerprints differ in at most ``radius`` bits are linked; a component
    is all that is reachable, and its id is the smallest doc_id in it (nulls ignored;
    null if all are null). Texts without words, null ones too, have fingerprint zero
    and are linked like others. Exactly one row of a component has _stays set: of the
    smallest doc_id, whichever if that id repeats. An empty table gives an empty result.

    Scale: equal fingerprints are merged first, so copies cost nothing. Each distinct one
    makes 2^(radius+1) - 1 rows of two numbers; buckets of one are dropped where they
    meet, and of the others only the links of a spanning forest go on.
    """
    rows = fingerprints(docs, text, doc_id, shingle, seed)
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("_first")
    values = materialise(rows.groupBy("fp").agg(first, F.count(F.lit(1)).alias("_rows")))
    roots = components(links(values.select("fp"), radius))
    rooted = values.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = materialise(rooted.withColumn("root", F.coalesce("root", "fp")))
    tops = rooted.groupBy("root").agg(F.min("_first").alias("_top"), F.count(F.lit(1)).alias("_values"))
    values = join_groups(rooted.drop("_first"), materialise(tops), ["root"], "_values").select("fp", "_rows", "_top")
    return join_groups(rows, materialise(values), ["fp"], "_rows").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("_top.doc_id").alias("component_id"),
        "_key",
        (F.col("_row") == F.col("_top._row")).alias("_stays"),
    )


def drop_near(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row of each component, with all its columns (see ``near_groups``)."""
    groups = materialise(near_groups(docs, text, doc_id, **options))
    kept = groups.groupBy(F.col("doc_id").alias("_id"), "_key").agg(
        F.count(F.lit(1)).alias("_rows"), F.bool_or("_stays").alias("_kept")
    )
    return keep_one(docs, kept.filter("_kept").drop("_kept"), doc_id, F.xxhash64(whole_text(text)))


# Near copies by their words. A replaced word changes five shingles, but one word: at a similarity of 0.8 of five-word
# shingles some 2 % of the words are others, so that two texts differ in some 4 of 64 bits made of words, and 10 of 64 made
# of shingles. Words weigh the square root of how often they occur: then 2 % of the words are 2 % of the weight, however often words repeat.
WORD_PRINTS = 4
ALIKE_SHINGLE = 5
# Bits by which the 128 bits of shingles may differ: near copies of 0.8 differ in some 19, give or take 4, unrelated
# texts in 64, give or take 6.
APART = 30
# The multipliers of the 64-bit finalizer by which a second hash is drawn from the first.
_STIR = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def shingle_prints(text: str, shingle: int = ALIKE_SHINGLE, seed: int = SEED) -> np.ndarray:
    """Two fingerprints as ``simhash``, the second by a hash drawn from the first."""
    ones, total = np.zeros(2 * BITS, np.int64), 0
    for hashes in shingle_hashes(text, shingle, seed):
        total += len(hashes)
        for at in range(0, len(hashes), 8192):
            first = hashes[at : at + 8192]
            second = (first ^ (first >> np.uint64(30))) * np.uint64(_STIR[0])
            second = (second ^ (second >> np.uint64(27))) * np.uint64(_STIR[1])
            both = np.stack([first, second ^ (second >> np.uint64(31))], axis=1)
            bits = np.unpackbits(both.view(np.uint8).reshape(-1, 16), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > total, bitorder="little").view(np.uint64)


def word_prints(text: str, seed: int = SEED) -> np.ndarray:
    """WORD_PRINTS independent fingerprints of the weighted lower-cased words; zeros for a text without words."""
    import xxhash

    times: Counter[bytes] = Counter()
    for block in word_blocks(text, 1):
        times.update(block)
    words = list(times)
    # Whole numbers below 2^53 in all, so that sums are exact in any order.
    weights = np.floor(256 * np.sqrt(np.fromiter(times.values(), np.float64, len(words))))
    ones = np.zeros(BITS * WORD_PRINTS)
    for at in range(0, len(words), 2048):
        part = words[at : at + 2048]
        drawn = b"".join(xxhash.xxh3_128_digest(w, seed + i) for w in part for i in range(WORD_PRINTS // 2))
        bits = np.unpackbits(np.frombuffer(drawn, np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
        ones += weights[at : at + 2048] @ bits.astype(np.float64)
    return np.packbits(2 * ones > weights.sum(), bitorder="little").view(np.uint64)


def _close(words: np.ndarray, shingles: np.ndarray, a, b, radius: int, apart: int) -> np.ndarray:
    near = np.bitwise_count(words[a] ^ words[b]) <= radius
    return near & (np.bitwise_count(shingles[a] ^ shingles[b]).sum(axis=-1) <= apart)


def _alike_forest(words: np.ndarray, shingles: np.ndarray, radius: int, apart: int) -> list[tuple[int, int]]:
    """Places of pairs within both limits that connect all that such pairs would connect. Memory: that of the values."""
    rest, waiting, links = np.arange(1, len(words)), [0], []
    while rest.size:
        if not waiting:
            waiting, rest = [int(rest[0])], rest[1:]
            continue
        here = waiting.pop()
        near = _close(words, shingles, rest, here, radius, apart)
        if near.any():
            found = rest[near].tolist()
            links.extend((here, x) for x in found)
            waiting.extend(found)
            rest = rest[~near]
    return links


def _alike(radius: int, apart: int):
    """Links within each run of equal buckets; rows come sorted by bucket."""

    def of_runs(bucket, node, words, shingles) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        starts, ends = np.r_[0, cuts], np.r_[cuts, len(bucket)]
        two = starts[ends - starts == 2]
        near = _close(words, shingles, two, two + 1, radius, apart)
        us, vs = [node[two[near]]], [node[two[near] + 1]]
        for s, e in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
            if links := _alike_forest(words[s:e], shingles[s:e], radius, apart):
                pairs = np.array(links) + s
                us.append(node[pairs[:, 0]])
                vs.append(node[pairs[:, 1]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    def run(batches):
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros((0, 2), np.uint64)]
        for batch in batches:
            bucket, node, words, first, second = (batch[c].to_numpy() for c in ("bucket", "node", "w", "s0", "s1"))
            new = [bucket, node, words.view(np.uint64), np.stack([first, second], axis=1).view(np.uint64)]
            held = [np.concatenate([h, n]) for h, n in zip(held, new)]
            bucket = held[0]
            if not len(bucket) or bucket[0] == bucket[-1]:
                continue
            last = int(np.flatnonzero(np.diff(bucket))[-1]) + 1
            yield of_runs(*[h[:last] for h in held])
            held = [h[last:] for h in held]
        if len(held[0]):
            yield of_runs(*held)

    return run


def _shared(rows: DataFrame, family: list[int], *within: str) -> DataFrame:
    """A row per table: its bucket (``within`` it) and how many share it; those alone in theirs are dropped."""
    buckets = [F.xxhash64(*within, F.lit(t), F.col("w").bitwiseAND(F.lit(_signed(m)))) for t, m in enumerate(family)]
    tables = rows.select("node", "w", "s0", "s1", F.explode(F.array(*buckets)).alias("bucket"))
    return tables.withColumn("_in", F.count(F.lit(1)).over(Window.partitionBy("bucket"))).filter("_in > 1")


def similar_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    radius: int = RADIUS,
    apart: int = APART,
    shingle: int = ALIKE_SHINGLE,
    seed: int = SEED,
    large: int = LARGE_BUCKET,
) -> DataFrame:
    """Every row with its class of near copies: doc_id, component_id, and _key, _stays for ``drop_similar``.

    Two texts are linked if one of their fingerprints of words differs in at most ``radius`` bits, found by
    covering masks as in ``near_groups``, and the 128 bits of their shingles in at most ``apart``. The words find
    near copies of a similarity of 0.8 and more, nine in ten at least; the shingles tell texts that only
    share a vocabulary, as very long ones do. Ids, nulls, empty texts, repeated rows and empty tables are
    treated as in ``near_groups``; a text of fewer words than a shingle is linked to those with the same sequence of words only.

    Scale: rows that agree in all fingerprints are merged first. Each distinct one makes WORD_PRINTS *
    (2^(radius+1) - 1) rows of five numbers. A bucket's rows are held in a task, at 40 bytes each;
    buckets of more than ``large`` are dealt out by a second family first. A large group of near copies with
    texts of their own meets in most buckets of both families, which makes some 3,800 rows of each: not for tables with such groups yet.
    """
    of_words = [f"w{i}" for i in range(WORD_PRINTS)]
    prints = ["s0", "s1", *of_words]
    named_rows = named(docs, {"doc_id": doc_id, "_text": text}).select(
        "doc_id", whole_text("_text").alias("_text"), F.xxhash64(whole_text("_text")).alias("_key")
    )

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                t = batch.slice(at, 512)
                texts = [x.as_py() for x in t["_text"]]
                found = [np.concatenate([shingle_prints(x, shingle, seed), word_prints(x, seed)]) for x in texts]
                found = np.array(found, np.uint64).reshape(-1, len(prints)).view(np.int64)
                columns = [t["doc_id"], t["_key"], *[pa.array(found[:, i]) for i in range(len(prints))]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "_key", *prints])

    schema = f"doc_id {dict(named_rows.dtypes)['doc_id']}, _key long, " + ", ".join(f"{p} long" for p in prints)
    rows = materialise(named_rows.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("_first")
    values = rows.groupBy(*prints).agg(first, F.count(F.lit(1)).alias("_rows"))
    values = materialise(values.withColumn("node", F.monotonically_increasing_id()))
    each = values.select("node", "s0", "s1", F.posexplode(F.array(*of_words)).alias("k", "w"))
    found = _shared(each, masks(radius), "k")
    small, big = found.filter(F.col("_in") <= large), found.filter(F.col("_in") > large)
    again = _shared(big.select("node", "w", "s0", "s1", F.col("bucket").alias("k")), masks(radius, step=19), "k")
    pairs = [
        x.sortWithinPartitions("bucket").select("bucket", "node", "w", "s0", "s1").mapInArrow(_alike(radius, apart), "u long, v long")
        for x in (small, again)
    ]
    roots = components(pairs[0].unionByName(pairs[1]).distinct())
    rooted = values.join(roots, "node", "left")
    rooted = materialise(rooted.withColumn("root", F.coalesce("root", "node")))
    tops = rooted.groupBy("root").agg(F.min("_first").alias("_top"), F.count(F.lit(1)).alias("_values"))
    placed = join_groups(rooted.drop("_first"), materialise(tops), ["root"], "_values")
    placed = materialise(placed.select(*prints, "_rows", "_top"))
    return join_groups(rows, placed, prints, "_rows").select(
        "doc_id", F.col("_top.doc_id").alias("component_id"), "_key", (F.col("_row") == F.col("_top._row")).alias("_stays")
    )


def drop_similar(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row of each class of near copies, with all its columns (see ``similar_groups``)."""
    groups = materialise(similar_groups(docs, text, doc_id, **options))
    kept = groups.groupBy(F.col("doc_id").alias("_id"), "_key").agg(
        F.count(F.lit(1)).alias("_rows"), F.bool_or("_stays").alias("_kept")
    )
    return keep_one(docs, kept.filter("_kept").drop("_kept"), doc_id, F.xxhash64(whole_text(text)))
