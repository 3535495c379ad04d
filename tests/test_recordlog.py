"""The sharded log source: shares of a capped micro-batch, positions, restart, finished and new shards."""

import pytest
from pyspark.sql import functions as F

from recordflow.sources import recordlog as L

SCHEMA = "seq bigint, kind string, extra int"


def test_shares_pass_on_what_a_shard_does_not_need():
    assert L.shares({"a": 1000, "b": 2, "c": 5}, 30) == {"b": 2, "c": 5, "a": 23}
    assert L.shares({"a": 10, "b": 10, "c": 10}, 8) == {"a": 2, "b": 3, "c": 3}
    assert L.shares({"a": 10}, None) == {"a": 10} and L.shares({}, 5) == {}
    assert sum(L.shares({str(i): i for i in range(50)}, 77).values()) == 77


def put(spark, path, shard, numbers, row_group=None):
    df = spark.createDataFrame([(n, f"k{n}") for n in numbers], "seq long, kind string").withColumn("shard", F.lit(shard)).coalesce(1)
    writer = df.write.mode("append").partitionBy("shard")
    if row_group:
        writer = writer.option("parquet.block.size", row_group).option("parquet.block.size.row.check.max", 10)
    writer.parquet(path)


def reader(path, tmp_path, **options):
    from pyspark.sql.datasource import CaseInsensitiveDict
    from pyspark.sql.types import _parse_datatype_string

    given = {"path": path, "positions": f"{tmp_path}/positions", "refreshSeconds": "0", **options}
    return L.RecordLogStream(CaseInsensitiveDict(given), _parse_datatype_string(f"{SCHEMA}, shard string"))


def drain(r, offset):
    """All micro-batches from an offset: the numbers of each, and the last offset."""
    out = []
    while (end := r.latestOffset()) != offset:
        rows = [x for p in r.partitions(offset, end) for b in r.read(p) for x in b.to_pylist()]
        out.append(sorted((x["shard"], x["seq"]) for x in rows))
        offset = end
    return out, offset


def test_batches_are_capped_and_lose_nothing(spark, tmp_path):
    path = f"{tmp_path}/log"
    put(spark, path, "hot", range(0, 200, 2))
    put(spark, path, "hot", range(1, 200, 2))  # numbers of two files that lie between each other's
    put(spark, path, "small", range(7))
    put(spark, path, "negative", [-5, -4])
    r = reader(path, tmp_path, maxRowsPerBatch="30", rowsPerPartition="8")
    batches, end = drain(r, r.initialOffset())
    assert all(0 < len(b) <= 30 for b in batches) and len(batches) == 7
    want = [("hot", n) for n in range(200)] + [("small", n) for n in range(7)] + [("negative", n) for n in (-5, -4)]
    assert sorted(x for b in batches for x in b) == sorted(want)
    assert {x[0] for x in batches[0]} == {"hot", "small", "negative"}
    # A new reader of the same query goes on behind what was planned.
    again = reader(path, tmp_path, maxRowsPerBatch="30")
    assert again.latestOffset() == end
    put(spark, path, "hot", [200])
    assert drain(again, end)[0] == [[("hot", 200)]]


def test_finished_and_new_shards(spark, tmp_path):
    path = f"{tmp_path}/log"
    put(spark, path, "a", range(5))
    L.close_shard(path, "a")
    L.close_shard(path, "never-used")
    r = reader(path, tmp_path, startAfter='{"a": 2}')
    batches, end = drain(r, r.initialOffset())
    assert batches[0] == [("a", 3), ("a", 4)] and end == {"at": {}, "done": {"a": 4, "never-used": L.BEFORE_ALL}}
    put(spark, path, "b", [1])
    put(spark, path, "a", [9])  # nothing is read of a finished shard
    assert drain(r, end)[0] == [[("b", 1)]]


def test_missing_columns_nulls_and_empty_logs(spark, tmp_path):
    path = f"{tmp_path}/log"
    r = reader(path, tmp_path)
    assert drain(r, r.initialOffset())[0] == []
    put(spark, path, "a", [1, None, 3])
    put(spark, path, "a", [])
    end = r.latestOffset()
    rows = [x for p in r.partitions(r.initialOffset(), end) for b in r.read(p) for x in b.to_pylist()]
    assert sorted((x["seq"], x["kind"], x["extra"], x["shard"]) for x in rows) == [(1, "k1", None, "a"), (3, "k3", None, "a")]
    with pytest.raises(ValueError):
        L.RecordLogStream({"path": path}, None)


def test_row_groups_are_dealt_out(spark, tmp_path):
    path = f"{tmp_path}/log"
    put(spark, path, "hot", range(5000), row_group=1024)
    r = reader(path, tmp_path, rowsPerPartition="500")
    end = r.latestOffset()
    assert len(r.partitions(r.initialOffset(), end)) > 3
    assert [len(b) for b in drain(r, r.initialOffset())[0]] == [5000]


def test_a_stopped_query_goes_on(spark, tmp_path):
    path, out = f"{tmp_path}/log", f"{tmp_path}/out"
    put(spark, path, "a", range(40))

    def go():
        stream = L.read_record_log(spark, path, SCHEMA, f"{tmp_path}/positions", max_rows=15, refresh_seconds=0)
        handle = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").start(out)
        handle.processAllAvailable()
        sizes = [p["numInputRows"] for p in handle.recentProgress if p["numInputRows"]]
        handle.stop()
        return sizes

    assert go() == [15, 15, 10]
    put(spark, path, "b", range(20))
    assert go() == [15, 5]
    rows = spark.read.parquet(out).selectExpr("src_partition['shard'] shard", "src_offset['seq'] seq").collect()
    assert sorted((r.shard, int(r.seq)) for r in rows) == [("a", n) for n in range(40)] + [("b", n) for n in range(20)]
