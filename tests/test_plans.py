"""Properties of the physical plans: what is pushed down, what is shuffled, where Python runs."""

import glob
from decimal import Decimal

import pytest
import __spark_entry__ as registered
from recordflow.catalog import COVERS
from recordflow.operators import accounting, batching, contract, mapping, merge, model, privacy, profiling, rules
from recordflow.operators.contract import Contract
from recordflow.operators.reuse import samples_per_structure
from recordflow.sources.incremental import read_incremental

DATA = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    df._jdf.queryExecution().executedPlan()
    return df._jdf.queryExecution().toString() if mode == "full" else df._sc._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), mode
    )


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{DATA}/orders.parquet")


def test_offset_and_columns_reach_the_scan(orders):
    text = plan(read_incremental(orders, "incrementing", id_col="o_orderkey", offset={"id": 5}, ordered=False).select("o_orderkey"))
    assert "GreaterThan(o_orderkey,5)" in text and "ReadSchema: struct<o_orderkey:bigint>" in text
    assert "Exchange" not in text


def test_page_is_a_top_k(orders):
    text = plan(read_incremental(orders, "timestamp+incrementing", "o_orderdate", "o_orderkey", {"id": 5}, limit=10))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


RECORDS = "select id ordinal, concat('{\"aB\":', id, ',\"ssn\":\"', id, '\"}') value from range(50)"


@pytest.mark.parametrize(
    "step",
    [
        lambda df: mapping.apply_mapping(df, {"mappings": {"x": "$.aB"}, "typeCasts": {"x": "string"}}),
        lambda df: rules.apply_patterns(df),
        lambda df: contract.validate(df, Contract.parse({"properties": {"aB": {"type": "integer"}}})),
        lambda df: contract.split(contract.validate(df, Contract.parse({"properties": {"aB": {"type": "integer"}}})))[0],
        lambda df: privacy.unmask(privacy.mask(df, ["ssn"], ["[0-9]"])),
        lambda df: profiling.record_profile(df),
        lambda df: profiling.route(df, {1: "m"}, granularity="record"),
        lambda df: profiling.with_fingerprint(df),
        lambda df: accounting.call_cost(df.selectExpr("'gpt-4o' model", "ordinal input_tokens", "0L output_tokens", "0L cache_create_tokens", "0L cache_read_tokens")),
    ],
)
def test_record_steps_need_no_shuffle_and_no_python(spark, step):
    text = plan(step(spark.sql(RECORDS)))
    assert "Exchange" not in text and "Python" not in text and "Pandas" not in text


def test_each_record_is_parsed_once_per_step(spark):
    df = contract.validate(
        mapping.apply_mapping(spark.sql(RECORDS), {"mappings": {"x": "$.aB", "y": "$.ssn"}, "typeCasts": {"x": "number"}}),
        Contract.parse({"properties": {"x": {"type": "number"}, "y": {"type": "string", "enum": ["1", "2"]}}}),
    )
    good, _ = contract.split(df)
    optimized = good._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("parseJson(") == 2


def test_samples_are_limited_before_the_shuffle(spark):
    df = spark.sql("select id ordinal, cast(id % 2 as string) fingerprint, 'v' value from range(100)")
    text = plan(samples_per_structure(df, "ordinal"))
    # plans print the last step first: the limit has to show up below the exchange as well
    assert "WindowGroupLimit" in text.split("Exchange", 1)[1]


def test_batches_use_no_window_over_the_rows(spark):
    text = plan(batching.assign_batches(spark.sql(RECORDS), ["ordinal"], 7))
    # the only window runs over one row per range
    assert text.count("Window") <= 4 and "BroadcastHashJoin" in text


def test_small_change_sets_do_not_shuffle_the_target(spark, orders):
    changes = spark.createDataFrame([(1, 2, "O", 5.0, 1)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, seq long")
    target = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    out = merge.merge_upsert(target, changes, ["o_orderkey"], "seq")
    out.collect()
    assert "BroadcastHashJoin" in plan(out)


def test_live_counters(spark):
    df, counters = accounting.observed(spark.sql("select array('e') errors union all select array()"), "run", "errors")
    df.collect()
    assert counters.get == {"processed": 2, "failed": 1}


def test_prompts_are_columns(spark):
    batches = batching.serialize_batches(spark.sql("select 1 batch_id, 0 ordinal, 'k' key, '{}' value"))
    assert "Python" not in plan(model.build_prompts(batches, "x"))


# ---------------------------------------------------------------- registry


def test_registry_is_consistent():
    queries, oracle = registered.queries(), registered.oracle_sql()
    assert set(oracle) <= set(queries) and set(COVERS) <= set(queries)
    assert len(queries) >= 120


def test_flagship(spark):
    assert registered.entry(spark).count() > 0


SAMPLE = ["gapless_incremental", "change_decode", "mapping_defaults", "contract_errors", "masked_records", "exact_reuse", "usage_cube", "merge_by_column"]


@pytest.mark.parametrize("name", SAMPLE)
def test_against_the_stated_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {path.split('/')[-1][:-8]} AS SELECT * FROM '{path}'")
    cursor = con.execute(registered.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    df = registered.queries()[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)

    def canonical(rows, columns):
        at = sorted(range(len(columns)), key=columns.__getitem__)
        shown = lambda v: f"{float(v):.9g}" if isinstance(v, (int, float, Decimal)) and not isinstance(v, bool) else str(v)
        return sorted(tuple(shown(r[i]) for i in at) for r in rows)

    assert canonical(df.collect(), df.columns) == canonical(cursor.fetchall(), names)


def test_skewed_join_is_left_to_adaptive_execution(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
