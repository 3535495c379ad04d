"""Sharding by fixed virtual slots and a versioned map from slots to shards.

A record's slot depends on its key alone and never changes. Bytes are summed per
slot, and a small table says which shard holds which slot. Rebalancing writes a
new version of that table in which as few bytes as needed have moved. A slot far
larger than the others (one key holding a third of all rows) is cut into parts
along the order of its rows, and its parts are mapped one by one.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, named, running_total, whole_text

SLOTS = 4096
# A slot is cut when it holds more than this share of an even shard.
PARTS_PER_SHARD = 64


@dataclass(frozen=True)
class SlotMap:
    """Shard of every (slot, part), with the bytes it had when the version was made."""

    version: int
    shards: int
    bytes_of: dict[tuple[int, int], int]
    shard_of: dict[tuple[int, int], int]

    @classmethod
    def balanced(cls, bytes_of: dict[tuple[int, int], int], shards: int) -> SlotMap:
        """First version: largest first, each to the shard with least so far."""
        loads = [(0, s) for s in range(shards)]
        shard_of = {}
        for place in sorted(bytes_of, key=lambda p: (-bytes_of[p], p)):
            load, shard = heapq.heappop(loads)
            shard_of[place] = shard
            heapq.heappush(loads, (load + bytes_of[place], shard))
        return cls(1, shards, dict(bytes_of), shard_of)

    @classmethod
    def even(cls, shards: int, slots: int = SLOTS) -> SlotMap:
        """First version before anything is known of the bytes: slots dealt out in turn."""
        return cls(1, shards, {(k, 0): 0 for k in range(slots)}, {(k, 0): k % shards for k in range(slots)})

    def loads(self) -> list[int]:
        out = [0] * self.shards
        for place, shard in self.shard_of.items():
            out[shard] += self.bytes_of.get(place, 0)
        return out

    def rebalanced(self, bytes_of: dict[tuple[int, int], int], shards: int | None = None) -> SlotMap:
        """Next version for changed bytes or more shards: single moves from the fullest to the emptiest shard.

        Places not seen before go to the emptiest shard. Every move narrows the gap, and
        nothing else changes; new shards take slots only into themselves. Fewer shards
        than before is an error: move their slots first.
        """
        shards = shards or self.shards
        if shards < self.shards:
            raise ValueError("a map cannot lose shards")
        shard_of = {p: s for p, s in self.shard_of.items() if p in bytes_of}
        held: list[set] = [set() for _ in range(shards)]
        loads = [0] * shards
        for place, shard in shard_of.items():
            held[shard].add(place)
            loads[shard] += bytes_of[place]
        for place in sorted(set(bytes_of) - set(shard_of), key=lambda p: (-bytes_of[p], p)):
            shard = min(range(shards), key=lambda s: (loads[s], s))
            shard_of[place] = shard
            held[shard].add(place)
            loads[shard] += bytes_of[place]
        takers = range(self.shards, shards) if shards > self.shards else range(shards)
        while True:
            full, empty = max(range(shards), key=lambda s: (loads[s], -s)), min(takers, key=lambda s: (loads[s], s))
            gap = loads[full] - loads[empty]
            fitting = [p for p in held[full] if 0 < bytes_of[p] < gap]
            if not fitting:
                break
            place = min(fitting, key=lambda p: (abs(gap - 2 * bytes_of[p]), p))
            held[full].remove(place)
            held[empty].add(place)
            shard_of[place] = empty
            loads[full] -= bytes_of[place]
            loads[empty] += bytes_of[place]
        return replace(self, version=self.version + 1, shards=shards, bytes_of=dict(bytes_of), shard_of=shard_of)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, self.shards, *p, s, self.bytes_of[p]) for p, s in sorted(self.shard_of.items())]
        return spark.createDataFrame(
            rows, "version int, shards int, virtual_slot long, part long, shard int, place_bytes long"
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Add this version to the table at ``path``; earlier versions stay readable."""
        self.table(spark).coalesce(1).write.parquet(f"{path}/at={self.version}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A stored version, by default the latest. Bounded by the number of slots and parts."""
        table = spark.read.parquet(path)
        version = version if version is not None else table.agg(F.max("version")).first()[0]
        rows = table.filter(F.col("version") == version).collect()
        places = {(r.virtual_slot, r.part): r for r in rows}
        return cls(
            version,
            rows[0].shards,
            {p: r.place_bytes for p, r in places.items()},
            {p: r.shard for p, r in places.items()},
        )


def placed(docs: DataFrame, shards: int, text: str = "text", doc_id: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """Every row with its size, checksum, virtual slot and part, and the range it lies in. Stored.

    Size: UTF-8 bytes of the text and one more. Null text has no bytes, a null id is
    a key like any other. Other columns are not read.
    """
    rows = named(docs, {"doc_id": doc_id, "_text": text}).select(
        "doc_id",
        (F.octet_length(whole_text("_text")) + 1).cast("long").alias("size"),
        F.crc32(whole_text("_text")).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(slots)).alias("virtual_slot"),
    )
    summed = running_total(rows, ["virtual_slot"], ["doc_id", "text_crc32", "size"], "size", "_before")
    summed = materialise(summed)
    total = summed.agg(F.sum("size")).first()[0] or 0
    limit = max(1, -(-total // (shards * PARTS_PER_SHARD)))
    return summed.withColumn("part", F.floor(F.col("_before") / F.lit(limit)).cast("long"))


def place_bytes(rows: DataFrame) -> dict[tuple[int, int], int]:
    """Bytes per slot and part: at most ``slots`` + ``shards`` x PARTS_PER_SHARD rows."""
    summed = rows.groupBy("virtual_slot", "part").agg(F.sum("size").alias("b")).collect()
    return {(r.virtual_slot, r.part): r.b for r in summed}


def shard(docs: DataFrame, shards: int = 8, map_path: str | None = None, **columns) -> DataFrame:
    """All rows with shard and place in it: doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, part.

    Law `bytes`: the sizes of the shards are near equal. ``slot`` counts the rows of a
    shard from 0 without gaps, in the order (virtual slot, part, doc_id, checksum, size);
    repeated rows are interchangeable. With ``map_path`` the map stored there is
    edited for the bytes of now and the new version added; without, a first one is made.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = placed(docs, shards, **columns)
    sizes = place_bytes(rows)
    if map_path is not None and _stored(spark, map_path):
        slot_map = SlotMap.load(spark, map_path).rebalanced(sizes, shards)
    else:
        slot_map = SlotMap.balanced(sizes, shards)
    if map_path is not None and sizes:
        slot_map.save(spark, map_path)
    # Rows are placed by the version as it is stored: one row per slot and part.
    mapped = slot_map.table(spark)
    if map_path is not None and sizes:
        mapped = spark.read.parquet(map_path).filter(F.col("version") == slot_map.version)
    # One row per slot, part and range of rows: bounded by slots, parts and ranges.
    ends = rows.groupBy("virtual_slot", "part", "_chunk").agg(F.count(F.lit(1)).alias("_rows"))
    ends = ends.join(F.broadcast(mapped.select("virtual_slot", "part", "shard")), ["virtual_slot", "part"])
    along = Window.partitionBy("shard").orderBy("virtual_slot", "part", "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.withColumn("_start", F.coalesce(F.sum("_rows").over(along), F.lit(0))).drop("_rows")
    within = Window.partitionBy("virtual_slot", "part", "_chunk").orderBy("_before", "size")
    return (
        rows.withColumn("_at", F.row_number().over(within) - 1)
        .join(starts, ["virtual_slot", "part", "_chunk"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("_start") + F.col("_at")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
            "part",
        )
    )


def _stored(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
