"""Cost, usage and health of model calls, from the call log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .staging import fill_sequence

# US dollars per million input and output tokens, and the factors on
# the input price for tokens written to and read from a prompt cache. A model name
# is priced by the longest key it contains.
PRICES = {
    "claude-opus": (15.0, 75.0, 1.25, 0.1),
    "claude-sonnet": (3.0, 15.0, 1.25, 0.1),
    "claude-haiku": (0.25, 1.25, 1.25, 0.1),
    "gpt-4o-mini": (0.15, 0.60, 1.0, 1.0),
    "gpt-4.1": (2.0, 8.0, 1.0, 1.0),
    "gpt-4o": (2.50, 10.0, 1.0, 1.0),
}


def price_key(model: Column, prices: dict[str, tuple] = PRICES) -> Column:
    """The longest price key contained in the lower-cased model name, else NULL."""
    found = F.lit(None).cast("string")
    for key in sorted(prices, key=len):
        found = F.when(F.lower(model).contains(key), F.lit(key)).otherwise(found)
    return found


def call_cost(
    calls: DataFrame,
    prices: dict[str, tuple] = PRICES,
    includes_cached: tuple[str, ...] = (),
    out: str = "cost_usd",
) -> DataFrame:
    """Adds ``price_key`` and the cost of each call; unknown or missing models cost nothing.

    Price keys in ``includes_cached`` report cached tokens inside the input
    tokens, so those are not billed twice. By default they are added on top.
    """
    keyed = calls.withColumn("price_key", price_key(F.col("model"), prices))
    cost = F.lit(0.0)
    for key, (per_input, per_output, create, read) in prices.items():
        billed = F.col("input_tokens")
        if key in includes_cached:
            billed = billed - F.col("cache_create_tokens") - F.col("cache_read_tokens")
        one = (
            billed / 1e6 * per_input
            + F.col("output_tokens") / 1e6 * per_output
            + F.col("cache_create_tokens") / 1e6 * per_input * create
            + F.col("cache_read_tokens") / 1e6 * per_input * read
        )
        cost = F.when(F.col("price_key") == key, one).otherwise(cost)
    return keyed.withColumn(out, cost)


def hit_ratio(hits: Column, lookups: Column) -> Column:
    return F.when(lookups > 0, hits / lookups).otherwise(F.lit(0.0))


def run_metrics(log: DataFrame) -> DataFrame:
    """One row of totals over a call log.

    Expected columns: records, failed, called, input_tokens, output_tokens,
    cost_usd, cache_hit, tier, compiled (hit, miss, compile, invalidate or NULL),
    rate_limited.
    """
    hits = F.count_if(F.col("cache_hit"))
    lookups = F.count("cache_hit")
    return log.agg(
        F.sum("records").alias("processed"),
        F.sum("failed").alias("failed"),
        F.count_if("called").alias("calls"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum("cost_usd").alias("cost_usd"),
        hits.alias("cache_hits"),
        (lookups - hits).alias("cache_misses"),
        hit_ratio(hits, lookups).alias("cache_hit_ratio"),
        *[F.count_if(F.col("tier") == t).alias(f"tier_{t}") for t in range(4)],
        *[F.count_if(F.col("compiled") == c).alias(f"compiled_{c}") for c in ("hit", "miss", "compile", "invalidate")],
        F.count_if("rate_limited").alias("rate_limited"),
    )


def observed(records: DataFrame, name: str, errors: str | None = None) -> tuple[DataFrame, Observation]:
    """The same frame with live counters, filled while an action runs over it; no extra pass."""
    observation = Observation(name)
    counters = [F.count(F.lit(1)).alias("processed")]
    if errors is not None:
        counters.append(F.count_if(F.size(errors) > 0).alias("failed"))
    return records.observe(observation, *counters), observation


def cache_hit_ratio(lookups: DataFrame, hit: str = "hit", by: list[str] = ()) -> DataFrame:
    hits = F.count_if(F.col(hit))
    total = F.count(F.lit(1))
    return lookups.groupBy(*by).agg(
        hits.alias("hits"), total.alias("lookups"), hit_ratio(hits, total).alias("hit_ratio")
    )


def distributions(log: DataFrame, measures: list[str], by: list[str] = (), accuracy: int = 10000) -> DataFrame:
    """Count, mean, maximum and approximate percentiles of each measure, in one pass; ``usage_sketches`` can be stored and merged."""
    columns = []
    for m in measures:
        columns += [
            F.count(m).alias(f"{m}_count"),
            F.avg(m).alias(f"{m}_mean"),
            F.max(m).alias(f"{m}_max"),
            *[
                F.percentile_approx(m, q, accuracy).alias(f"{m}_p{int(q * 100)}")
                for q in (0.5, 0.95, 0.99)
            ],
        ]
    return log.groupBy(*by).agg(*columns)


# Sizes of sketches: items a KLL level keeps (its rank error is about 1.3 % at 200, 0.2 % at 1,600), and the logarithm
# of the registers of a HyperLogLog sketch (its error is about 0.8 % at 14).
KLL_ITEMS = 1600
HLL_LOG = 14


def usage_sketches(
    log: DataFrame, by: list[str], measures: list[str], distinct: list[str] = (), items: int = KLL_ITEMS, log_k: int = HLL_LOG
) -> DataFrame:
    """One row per group to be stored and merged later: ``records``, and binary sketches of its values.

    ``{m}_kll`` (quantiles) for each number in ``measures``, ``{d}_hll`` (distinct values) for each column in
    ``distinct``. Nulls are in no sketch; a group without a value has a null or empty one. Partial sketches are merged
    before the shuffle, so a group with a third of all rows costs one row per task. A sketch has some tens of
    kilobytes, however many values it stands for.
    """
    parts = [F.count(F.lit(1)).alias("records")]
    parts += [F.kll_sketch_agg_double(F.col(m).cast("double"), F.lit(items)).alias(f"{m}_kll") for m in measures]
    parts += [F.hll_sketch_agg(F.col(d).cast("string"), F.lit(log_k)).alias(f"{d}_hll") for d in distinct]
    return log.groupBy(*by).agg(*parts)


def merge_sketches(stored: DataFrame, by: list[str]) -> DataFrame:
    """Stored sketches of finer groups (days, batches, sources) as those of coarser ones; other columns are dropped."""
    parts = [F.sum("records").alias("records")]
    for name in stored.columns:
        if name.endswith("_kll") and name not in by:
            parts.append(F.kll_merge_agg_double(name).alias(name))
        elif name.endswith("_hll") and name not in by:
            parts.append(F.hll_union_agg(name).alias(name))
    return stored.groupBy(*by).agg(*parts)


def read_sketches(sketched: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """What sketches say: ``{m}_p{q}`` by nearest rank, and ``{d}_distinct``, in place of the binary columns.

    Quantiles are exact while a group has fewer values than a level of its sketch keeps; one without values has nulls.
    """
    out = []
    for name in sketched.columns:
        base = name[:-4]
        if name.endswith("_kll"):
            some = F.kll_sketch_get_n_double(name) > 0
            for q in quantiles:
                found = F.when(some, F.kll_sketch_get_quantile_double(F.when(some, F.col(name)), F.lit(q)))
                out.append(found.alias(f"{base}_p{q * 100:g}"))
        elif name.endswith("_hll"):
            out.append(F.coalesce(F.hll_sketch_estimate(name), F.lit(0)).alias(f"{base}_distinct"))
        else:
            out.append(F.col(f"`{name}`"))
    return sketched.select(*out)


def exact_percentiles(log: DataFrame, measure: str, by: list[str], quantiles: list[float]) -> DataFrame:
    """Nearest-rank percentiles per group from the ordered data: exact at any size, a large group is spread out.

    One row per group and quantile. ``distributions`` is the cheaper one-pass sketch.
    """
    rows = log.filter(F.col(measure).isNotNull()).select(*by, measure)
    ranked = fill_sequence(rows.withColumn("_none", F.lit(None).cast("bigint")), by, [measure], "_none", "_rank")
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    wanted = sizes.select(
        *by,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(q).alias("quantile"), F.greatest(F.ceil(F.col("_n") * q), F.lit(1)).alias("_rank"))
                    for q in quantiles
                ]
            )
        ).alias("_q"),
    ).select(*by, "_q.*")
    return ranked.select(*by, "_rank", F.col(measure).alias("value")).join(wanted, [*by, "_rank"]).drop("_rank")


def usage_report(log: DataFrame, by: list[str], mode: str = "group") -> DataFrame:
    """Calls, tokens, cost and latency per group. mode: group, rollup or cube."""
    grouped = {"group": log.groupBy, "rollup": log.rollup, "cube": log.cube}[mode](*by)
    return grouped.agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum("cost_usd").alias("cost_usd"),
        F.max("latency_ms").alias("max_latency_ms"),
    )


def alerts(
    log: DataFrame, by: list[str], budget_usd: float, p99_ms: float = 30_000.0, min_hit_ratio: float = 0.5
) -> DataFrame:
    """Groups breaking a limit, with the names of the limits broken."""
    hits, lookups = F.count_if(F.col("cache_hit")), F.count("cache_hit")
    measured = log.groupBy(*by).agg(
        F.sum("failed").alias("failed"),
        F.percentile_approx("latency_ms", 0.99, 10000).alias("p99_ms"),
        hit_ratio(hits, lookups).alias("hit_ratio"),
        lookups.alias("lookups"),
        F.sum("cost_usd").alias("cost_usd"),
    )
    broken = F.array_compact(
        F.array(
            F.when(F.col("failed") > 0, "failed"),
            F.when(F.col("p99_ms") > p99_ms, "latency"),
            F.when((F.col("lookups") > 0) & (F.col("hit_ratio") < min_hit_ratio), "hit_ratio"),
            F.when(F.col("cost_usd") > budget_usd, "cost"),
        )
    )
    return measured.withColumn("alerts", broken).filter(F.size("alerts") > 0)
