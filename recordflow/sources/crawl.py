"""Paged reads: the whole frontier of addresses is fetched one round at a time."""

from __future__ import annotations

import heapq
import time
from collections import defaultdict, deque
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paging import first_page_url, next_page_url
from ..operators.pace import Pace, paced_tasks
from ..operators.records import extract_records
from ..operators.staging import materialise, spread_count

_RESPONSE = "seed string, url string, status int, link string, body string"


def _host(url: str) -> str:
    return urlsplit(url).netloc.lower()


def fetch_with(
    fetch_fn: Callable[[str], dict],
    calls_per_second: float | None = None,
    per_host: float | None = None,
    retries: int = 0,
) -> Callable[[DataFrame], DataFrame]:
    """A fetcher from a plain function ``url -> {status, body, link?, retry_after?}``.

    ``calls_per_second`` is a budget for the whole job (see ``pace``), ``per_host`` one for each host: the addresses of
    a host then go to one task, which visits its hosts in turn. A status of 429 or 503 is tried again up to
    ``retries`` times; the seconds in ``retry_after`` (one without it) hold all addresses of that host, or of the task without ``per_host``.
    """

    def fetch(frontier: DataFrame) -> DataFrame:
        tasks = 1
        if calls_per_second:
            tasks = paced_tasks(frontier, calls_per_second)
        elif per_host:
            tasks = spread_count(frontier)
        if per_host:
            host = F.lower(F.regexp_extract("url", "^[^/?#]*//([^/?#]*)", 1))
            frontier = frontier.repartition(tasks, host)
        elif calls_per_second:
            frontier = frontier.repartition(tasks, "url")

        def run(frames):
            pace = Pace(calls_per_second, tasks, TaskContext.get().partitionId())
            hosts: dict[str, float] = {}
            for frame in frames:
                yield pd.DataFrame(fetched(frame, pace, hosts), columns=["seed", "url", "status", "link", "body"])

        return frontier.mapInPandas(run, _RESPONSE)

    def fetched(frame: pd.DataFrame, pace: Pace, hosts: dict[str, float]) -> Iterator[tuple]:
        """Answers of some addresses, the host that is free soonest first."""
        todo: dict[str, deque] = defaultdict(deque)
        for seed, url in zip(frame["seed"], frame["url"]):
            todo[_host(url) if per_host else ""].append((seed, url, 0))
        free = [(hosts.get(h, 0.0), h) for h in todo]
        heapq.heapify(free)
        while free:
            at, host = heapq.heappop(free)
            time.sleep(max(0.0, at - time.time()))
            pace.wait()
            began = time.time()
            seed, url, tried = todo[host].popleft()
            answer = fetch_fn(url)
            after = began + 1.0 / per_host if per_host else 0.0
            if int(answer["status"]) in (429, 503) and tried < retries:
                after = max(after, time.time() + float(answer.get("retry_after") or 1.0))
                todo[host].appendleft((seed, url, tried + 1))
            else:
                yield seed, url, int(answer["status"]), answer.get("link"), answer.get("body")
            hosts[host] = after
            if todo[host]:
                heapq.heappush(free, (after, host))

    return fetch


def crawl(
    seeds: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    paging: str = "none",
    content_path: str = "",
    max_rounds: int | None = None,
    **paging_options,
) -> DataFrame:
    """Fetch all pages behind the seed addresses and cut them into records.

    ``seeds`` has ``url``; ``fetch`` turns a frontier (seed, url) into responses
    (seed, url, status, link, body): ``fetch_with`` for a function, or a join
    with landed responses. Every round is stored before the next starts, so a
    lost executor repeats no finished round. A status of 400 or more fails, and so
    do pages that are left after ``max_rounds`` rounds.
    """
    frontier = seeds.select(
        F.col("url").alias("seed"), first_page_url(paging, F.col("url"), **paging_options).alias("url")
    ).dropDuplicates(["seed"])
    rounds: list[DataFrame] = []
    while True:
        if max_rounds is not None and len(rounds) >= max_rounds:
            if not frontier.isEmpty():
                raise RuntimeError(f"pages are left after {max_rounds} rounds, e.g. {frontier.first()['url']}")
            break
        # dropDuplicates has spread the frontier by address; later rounds keep that spread.
        responses = materialise(fetch(frontier).withColumn("round", F.lit(len(rounds))))
        head = responses.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("status") >= 400).alias("failed"),
            F.max(F.when(F.col("status") >= 400, F.struct("status", "url"))).alias("example"),
        ).first()
        if head["n"] == 0:
            break
        if head["failed"]:
            raise RuntimeError(f"{head['failed']} requests failed, e.g. {head['example']['status']} {head['example']['url']}")
        rounds.append(responses)
        frontier = responses.select(
            "seed",
            next_page_url(paging, F.col("url"), F.col("body"), F.col("link"), **paging_options).alias("url"),
        ).filter("url is not null")
    fetched = rounds[0] if rounds else fetch(frontier).withColumn("round", F.lit(0))
    for part in rounds[1:]:
        fetched = fetched.unionByName(part)
    return extract_records(fetched, content_path).drop("status", "link")
