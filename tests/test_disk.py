"""What keeps disk in step with the input: texts are stored as compressed columns, taken down once read, and their shuffles go."""

import os
import time
from urllib.parse import urlparse

from pyspark.sql import functions as F

from recordflow.catalog import QUERIES
from recordflow.operators.model import MappingClient
from recordflow.operators.staging import Shelf, ensure_checkpoint_dir
from recordflow.plans.config import BatchOptions, FlowConfig, MaskOptions
from recordflow.plans.flow import Pipeline


def _stored(spark):
    top = urlparse(ensure_checkpoint_dir(spark)).path
    return {p: os.path.getsize(p) for d, _, names in os.walk(top) for n in names if os.path.exists(p := os.path.join(d, n))}


def _shuffled(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    files = []
    while found.hasNext():
        files.append(found.next())
    return {f.getPath(): f.length() for f in files if f.getName().startswith("shuffle_")}


def _new(now, before):
    return sum(size for name, size in now.items() if name not in before)


def _left_on_disk(spark, name, folder):
    """Bytes of text, and bytes stored and shuffled that a query leaves behind."""
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.sha2(F.concat("id", F.lit(i)), 256) for i in range(60)]).alias("text"))
    docs.write.parquet(f"{folder}/documents.parquet")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    stored, shuffled = _stored(spark), _shuffled(spark)
    out = QUERIES[name](spark, str(folder))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.id: texts[r.id] in r.shown for r in out.collect()} == dict.fromkeys(texts, True)
    until = time.time() + 20  # shuffles are removed in the background
    while _new(_shuffled(spark), shuffled) > size / 4 and time.time() < until:
        time.sleep(0.2)
    return size, _new(_stored(spark), stored), _new(_shuffled(spark), shuffled)


def test_masked_texts_are_not_stored_many_times(spark, tmp_path):
    size, stored, shuffled = _left_on_disk(spark, "broken_texts_masked", tmp_path)
    assert stored < 2 * size
    assert shuffled < size / 4


def test_a_shelf_stores_what_comes_and_takes_it_down(spark):
    shelf = Shelf(spark)
    rows = spark.range(50).selectExpr("id", "array(map('k', id)) m", "named_struct('t', timestamp_seconds(id), 'v', parse_json('[1]')) s")
    kept, gone = shelf.put(rows.repartition(3)), shelf.put(rows)
    shelf.take_down(gone)
    assert kept.schema.simpleString() == rows.schema.simpleString()
    assert kept.selectExpr("sum(m[0]['k'])", "count(s.t)", "count(s.v)").first()[:] == (1225, 50, 50)
    assert all(not os.path.exists(urlparse(f).path) for f in gone.inputFiles()) and len(shelf._folders) == 1
    # Parquet has no intervals, no columns without a type and no two names that differ by case alone.
    odd = spark.sql("select 1 id, null nothing, make_interval(0, 1) span, named_struct('a', 1, 'A', 2) pair")
    assert shelf.put(odd).selectExpr("id", "nothing is null", "cast(span as string)", "to_json(pair)").first()[:] == (1, True, "1 months", '{"a":1,"A":2}')
    assert spark.conf.get(Shelf.TIDY) == "false"


def test_sources_of_any_type_come_with_their_records(spark):
    rows = spark.sql("select id ordinal, concat('k', id) key, concat('{\"a\":\"u', id, '@x\"}') value, null nothing, make_interval(0, cast(id as int)) span from range(9)")
    config = FlowConfig(batches=BatchOptions(size=4, order=()), masking=MaskOptions(patterns=("@x",)))
    found = Pipeline(config, MappingClient({"b": "a"})).transform(rows)
    got = found.good.selectExpr("key", "value", "source.ordinal", "source.key", "cast(source.span as string)", "source.nothing").collect()
    assert sorted(tuple(r) for r in got) == [(f"k{i}", f'{{"b":"u{i}@x"}}', i, f"k{i}", f"{i} months" if i else "0 seconds", None) for i in range(9)]
    assert found.quarantine.count() == 0


def test_whole_masked_texts_are_not_stored_many_times(spark, tmp_path):
    size, stored, shuffled = _left_on_disk(spark, "broken_whole_texts_masked", tmp_path)
    assert stored < 2 * size
    assert shuffled < size / 4
