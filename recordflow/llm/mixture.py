"""Mixing sources to target weights as a min-cost flow over membership patterns.

Documents are summed by membership pattern (the set of sources a document belongs
to). Each pattern can supply its words once, twice or three times, every further
time at a higher cost, to the quotas of its sources. The flow of least cost says
how many words each pattern gives to each source; documents are then taken in a
seeded order until that many words are reached.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, named, packed, running_total, word_count

WEIGHTS = (5, 2, 1)
# Cost of a word taken for the first, second and third time; increasing, so the flow spreads before it repeats.
REPEAT_COSTS = (1, 3, 6)
# A mixture is a list of sources kept on the driver; more patterns than this is an error, not a cut.
MAX_PATTERNS = 200_000


def fill_targets(sizes: list[int], weights: list[float], repeats: int) -> list[float]:
    """Shares of the whole by weight; none above ``repeats`` times its size, the excess shared again by weight."""
    total, targets, open_ = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        by_weight = sum(weights[i] for i in sorted(open_))
        for i in open_:
            targets[i] = total * weights[i] / by_weight
        above = {i for i in open_ if targets[i] > repeats * sizes[i]}
        if not above:
            break
        for i in sorted(above):
            targets[i] = float(repeats * sizes[i])
            total -= targets[i]
        open_ -= above
    return targets


def min_cost_flow(supplies: list[tuple[tuple[int, ...], int]], quotas: list[int], costs: tuple[int, ...]) -> dict:
    """Words from each pattern to each source at least cost, by successive shortest paths.

    ``supplies``: (sources of the pattern, words it has). Returns {(pattern, source): words}.
    Sources without a pattern in common never meet, but are solved in the same graph.
    """
    n, k = len(supplies), len(quotas)
    start, end = n + k, n + k + 1
    graph: list[list[list]] = [[] for _ in range(n + k + 2)]  # [to, room, cost, place of the reverse arc]

    def arc(a: int, b: int, room: int, cost: int) -> list:
        there, back = [b, room, cost, len(graph[b])], [a, 0, -cost, len(graph[a])]
        graph[a].append(there)
        graph[b].append(back)
        return there

    used = {}
    for i, (sources, words) in enumerate(supplies):
        for cost in costs:
            arc(start, i, words, cost)
        for s in sources:
            used[i, s] = arc(i, n + s, words * len(costs), 0)
    for s, quota in enumerate(quotas):
        arc(n + s, end, quota, 0)
    potential = [0] * len(graph)
    while True:
        far = [None] * len(graph)
        came: list = [None] * len(graph)
        far[start], queue = 0, [(0, start)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in graph[a]:
                if e[1] > 0:
                    there = d + e[2] + potential[a] - potential[e[0]]
                    if far[e[0]] is None or there < far[e[0]]:
                        far[e[0]], came[e[0]] = there, (a, e)
                        heapq.heappush(queue, (there, e[0]))
        if far[end] is None:
            break
        most = max(x for x in far if x is not None)
        potential = [p + (most if x is None else x) for p, x in zip(potential, far)]
        # All that fits along arcs of no reduced cost, before distances are computed again.
        while (path := _path(graph, potential, start, end)) is not None:
            room = min(e[1] for _, e in path)
            for _, e in path:
                e[1] -= room
                graph[e[0]][e[3]][1] += room
    return {key: graph[e[0]][e[3]][1] for key, e in used.items()}


def _path(graph: list, potential: list, start: int, end: int) -> list | None:
    """A path with room along arcs of reduced cost zero."""
    came, stack = {start: None}, [start]
    while stack:
        a = stack.pop()
        if a == end:
            path = []
            while came[a] is not None:
                path.append(came[a])
                a = came[a][0]
            return path
        for e in graph[a]:
            if e[1] > 0 and e[0] not in came and e[2] + potential[a] - potential[e[0]] == 0:
                came[e[0]] = (a, e)
                stack.append(e[0])
    return None


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    costs: tuple[int, ...] = REPEAT_COSTS,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    seed: int = 7,
) -> DataFrame:
    """Every row with the words the mix takes of it: doc_id, size, source_size, target, taken, copies, takers.

    ``source`` is a string, or an array of strings for documents of several sources.
    Size: words between blanks (null text: none). Sources in code point order, a null
    one last, weigh ``weights`` in turn; an empty or null array is the null source.
    A document is taken whole, at most len(costs) times; ``takers`` are the sources its
    copies go to. For several sources, source_size and target are sums over them.
    Repeated rows are documents of their own. Ties in the seeded order are ordered by
    id and size, so reruns agree. An empty table gives an empty result; tables
    whose texts are all empty take nothing. Other columns are not read.
    """
    spark = docs.sparkSession
    several = dict(docs.dtypes)[source].startswith("array")
    own = F.col("_source") if several else F.array("_source")
    own = F.when(F.coalesce(F.size(own), F.lit(0)) > 0, F.array_distinct(own)).otherwise(F.array(F.lit(None).cast("string")))
    # A pattern as one text: sorted names with a mark for null, so that null and '' differ.
    marked = F.array_sort(F.transform(own, lambda s: F.when(s.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), s))))
    rows = named(docs, {"doc_id": doc_id, "_text": text, "_source": source}).select(
        "doc_id",
        word_count("_text").alias("size"),
        F.to_json(marked).alias("_pattern"),
        F.xxhash64(F.lit(seed), F.col("doc_id")).alias("_draw"),
    )
    # Words before a document in the seeded order of its pattern.
    summed = materialise(running_total(rows, ["_pattern"], ["_draw", "doc_id", "size"], "size", "_before"))
    totals = summed.groupBy("_pattern").agg(F.sum("size").alias("size"))
    found = totals.withColumn("_names", F.from_json("_pattern", "array<string>")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns; map sources to coarser ones first")
    found.sort(key=lambda r: r._pattern)
    names = sorted({n for r in found for n in r._names})
    place = {n: i for i, n in enumerate(names)}
    source_sizes = [0] * len(names)
    for r in found:
        for n in r._names:
            source_sizes[place[n]] += r.size
    turn = [weights[i % len(weights)] for i in range(len(names))]
    targets = fill_targets(source_sizes, turn, len(costs))
    if several:  # a word counts once in the whole, however many sources have it
        whole = sum(r.size for r in found)
        scale = whole / max(1, sum(source_sizes))
        targets = [t * scale for t in targets]
    supplies = [(tuple(place[n] for n in r._names), r.size) for r in found]
    flow = min_cost_flow(supplies, [round(t) for t in targets], costs)
    plan = []
    for i, r in enumerate(found):
        ends, upto = [], 0
        for s in supplies[i][0]:
            upto += flow[i, s]
            ends.append((names[s][1:] if names[s][0] == "0" else None, upto))
        plan.append(
            (
                r._pattern,
                r.size,
                sum(source_sizes[s] for s in supplies[i][0]),
                float(sum(targets[s] for s in supplies[i][0])),
                ends,
            )
        )
    recipe = spark.createDataFrame(
        plan,
        "_pattern string, _words long, source_size long, target double, _ends array<struct<source:string,upto:long>>",
    )
    # Copy number c of a document starts at c times the pattern's words, plus the words before it.
    # It is taken if it ends within the flow, by the source whose stretch holds its middle.
    starts = F.transform(F.sequence(F.lit(0), F.lit(len(costs) - 1)), lambda c: c * F.col("_words") + F.col("_before"))
    flow_end = F.element_at("_ends", -1)["upto"]
    inside = F.filter(starts, lambda x: x + F.col("size") <= flow_end)
    takers = F.transform(
        inside, lambda x: F.filter("_ends", lambda e: 2 * x + F.col("size") <= 2 * e["upto"])[0]["source"]
    )
    none = F.array().cast("array<string>")
    drawn = (
        summed.join(F.broadcast(recipe), "_pattern")
        .withColumn("takers", F.when(F.col("size") > 0, takers).otherwise(none))
        .withColumn("copies", F.size("takers"))
    )
    # What is left of a pattern's flow goes to single further copies: twice the largest that fits, then the nearest.
    left = drawn.groupBy("_pattern").agg((F.first(flow_end) - F.sum(F.col("copies") * F.col("size"))).alias("n"))
    more = {r._pattern: (r.n, []) for r in left.collect()}
    for fits in (True, True, False):
        error = F.abs(F.col("_left") - F.col("size"))
        spare = (F.col("size") > 0) & (F.col("copies") < len(costs)) & ~F.array_contains("_extra", F.col("_before"))
        spare &= (F.col("size") <= F.col("_left")) if fits else (error < F.col("_left"))
        chosen = (
            drawn.join(F.broadcast(_further(spark, more)), "_pattern")
            .filter(spare)
            .groupBy("_pattern")
            .agg(F.min(F.struct(error.alias("error"), "_draw", "doc_id", "size", "_before")).alias("one"))
        )
        for r in chosen.collect():
            n, extra = more[r._pattern]
            more[r._pattern] = (n - r.one["size"], [*extra, r.one["_before"]])
    one_more = F.array_contains("_extra", F.col("_before")) & (F.col("size") > 0)
    last = F.array(F.element_at("_ends", -1)["source"])
    return (
        drawn.join(F.broadcast(_further(spark, more)), "_pattern")
        .withColumn("takers", F.when(one_more, F.concat("takers", last)).otherwise(F.col("takers")))
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            (F.size("takers") * F.col("size")).cast("long").alias("taken"),
            F.size("takers").alias("copies"),
            "takers",
        )
    )


def _further(spark: SparkSession, more: dict[str, tuple[int, list[int]]]) -> DataFrame:
    """Per pattern: words still to give, and the places of the documents that give one more copy."""
    rows = [(pattern, left, extra) for pattern, (left, extra) in more.items()]
    return spark.createDataFrame(rows, "_pattern string, _left long, _extra array<long>")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken (see ``mix``).

    Rows that repeat an id and a size are all taken as often as that one of them taken most.
    """
    text, doc_id = options.get("text", "text"), options.get("doc_id", "doc_id")
    taken = mix(docs, **options).groupBy("doc_id", "size").agg(F.max("copies").alias("_copies")).filter("_copies > 0")
    taken = taken.select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), "_copies")
    rows = docs.select(packed(docs), F.col(f"`{doc_id}`").alias("id"), word_count(text).alias("words"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("words") == F.col("_size"))
    repeated = rows.join(taken, same).select("doc", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select("doc.*")
