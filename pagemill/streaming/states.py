"""The frontier's checks, retries and queues as arbitrary state of a stream, on ``transformWithState``.

State is kept by key in several variables of their own, of which only what a row needs is read. Rows of a key are taken in order of arrival within
a micro-batch, and micro-batches follow each other, so where messages come in that order the outcomes do not depend on how a stream is cut. A batch that
runs again starts from the state before it. Keys are domains, URLs and shards; a key's rows of one micro-batch meet in one task, which the stream's
trigger bounds.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import takewhile

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.frontier import MOST_PER_DOMAIN, QUEUE_ORDER, RETRIES, RETRY_MINUTES

PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@contextmanager
def rocks(spark: SparkSession) -> Iterator[None]:
    """Queries that start within keep their state in RocksDB, which variables, timers and lifetimes need."""
    before = spark.conf.get(PROVIDER[0], None)
    spark.conf.set(*PROVIDER)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER[0])
        else:
            spark.conf.set(PROVIDER[0], before)


#: Distinct URLs of a domain in a micro-batch, from where on its state is read in a pass.
MANY = 64
#: What decides on a row.
NEEDED = ("kind", "url", "seed", "depth", "max_depth", "max_pages", "arrival")


class Discovery(StatefulProcessor):
    """Of a domain: the URLs seen, how many were added, and how many for each seed."""

    def __init__(self, most: int, keep_ms: int | None):
        self.most, self.keep_ms = most, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "url string", "arrival long", self.keep_ms)
        self.added = handle.getValueState("added", "n long")
        self.seeds = handle.getMapState("seeds", "seed string", "n long")

    def known(self, urls: set[str]) -> set[str]:
        """Those of the URLs that the state holds. Many are met in one pass over it, unless it holds more than are asked for; the rest is asked for one by one."""
        found = set()
        if len(urls) >= MANY:
            for k, (url,) in enumerate(self.seen.keys(), 1):
                if url in urls:
                    found.add(url)
                if k == len(urls):
                    break
            else:
                return found
        return found | {u for u in urls - found if self.seen.containsKey((u,))}

    def outcomes(self, rows: list) -> Iterator[tuple[str, int | None]]:
        """For rows in order of arrival, the first reason that holds against a row's URL, or "added", and the seed's pages then.

        What a micro-batch needs of the state is read before its first reset, from where on the state is empty until the end writes to it.
        """
        before = self.added.get() if self.added.exists() else None
        n = before[0] if before else 0
        seen = self.known({r.url for r in takewhile(lambda r: r.kind != "reset", rows)})
        seeds: dict[str, int] = {}
        fresh: dict[str, int] = {}
        forgotten = False
        for r in rows:
            url, seed = r.url, r.seed
            if r.kind == "reset":
                if not forgotten:
                    for state in (self.seen, self.added, self.seeds):
                        state.clear()
                forgotten, n = True, 0
                for known in (seen, seeds, fresh):
                    known.clear()
                yield "reset", None
            elif url in seen:
                yield "dedup_pending", None
            elif seed is None:
                if n >= self.most:
                    yield "domain_limit", None
                    continue
                n += 1
                seen.add(url)
                fresh[url] = r.arrival
                yield "added", None
            elif r.depth > r.max_depth:
                yield "scope_depth_limit", None
            else:
                if seed not in seeds:
                    seeds[seed] = self.seeds.getValue((seed,))[0] if not forgotten and self.seeds.containsKey((seed,)) else 0
                if seeds[seed] >= r.max_pages:
                    yield "scope_page_limit", None
                    continue
                seeds[seed] += 1
                seen.add(url)
                fresh[url] = r.arrival
                yield "added", seeds[seed]
        for url, arrival in fresh.items():
            self.seen.updateValue((url,), (arrival,))
        for seed, pages in seeds.items():
            self.seeds.updateValue((seed,), (pages,))
        self.added.update((n,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rows = sorted(rows, key=lambda r: r.arrival)
        for r, (outcome, pages) in zip(rows, self.outcomes(rows), strict=True):
            yield Row(domain=key[0], url=None if outcome == "reset" else r.url, arrival=r.arrival, outcome=outcome, pages=pages)


class FramedDiscovery(Discovery):
    """The same on frames, which cross to Python and back for a fraction of what single rows cost."""

    def handleInputRows(self, key, frames: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        rows = pd.concat(frames, ignore_index=True).sort_values("arrival", kind="stable")
        for c in ("url", "seed"):
            rows[c] = rows[c].astype(object).where(rows[c].notna(), None)
        told = list(self.outcomes(list(rows[[*NEEDED]].itertuples(index=False))))
        reset = (rows["kind"] == "reset").to_numpy()
        pages = pd.array([p for _, p in told], "Int64")
        yield pd.DataFrame({"domain": key[0], "url": rows["url"].mask(reset, None).to_numpy(), "arrival": rows["arrival"].to_numpy(), "outcome": [o for o, _ in told], "pages": pages})


def discover(rows: DataFrame, most: int = MOST_PER_DOMAIN, keep_hours: float | None = None) -> DataFrame:
    """Streamed rows (domain, kind, url, seed, depth, max_depth, max_pages, arrival) as (domain, url, arrival, outcome, pages).

    ``kind`` is url, or reset, which forgets all of the domain. URLs without a seed count towards the domain's cap, those with one towards its
    ``max_pages``, which ``pages`` numbers. What was added is a repeat for ``keep_hours``, without them for ever; what was refused may come again.
    """
    keep = None if keep_hours is None else int(keep_hours * 3_600_000)
    mode = "None" if keep is None else "ProcessingTime"
    # Limits that no row is held against are no nulls, so that frames keep whole numbers.
    scoped = (F.col("kind") != "reset") & F.col("seed").isNotNull()
    rows = rows.select("domain", *[F.when(scoped, F.col(c)).otherwise(0).alias(c) if c in ("depth", "max_depth", "max_pages") else c for c in NEEDED])
    return rows.groupBy("domain").transformWithStateInPandas(FramedDiscovery(most, keep), "domain string, url string, arrival long, outcome string, pages long", "append", mode)


class Retrying(StatefulProcessor):
    """Of a URL: failures in a row, and the attempts that wait for their timers."""

    def __init__(self, most: int, minutes: float):
        self.most, self.wait = most, int(minutes * 60_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.failures = handle.getValueState("failures", "n int")
        self.waiting = handle.getMapState("waiting", "due long", "attempt int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n = self.failures.get()[0] if self.failures.exists() else 0
        # What waits is read once; timers that begin and are called off within the micro-batch are never set.
        stored, new = {due for (due,) in self.waiting.keys()}, {}
        for r in sorted(rows, key=lambda r: r.at):
            at = int(r.at.timestamp() * 1000 + 0.0005)
            if r.success:
                n = 0
                for due in [d for d in stored if d > at]:
                    self.handle.deleteTimer(due)
                    self.waiting.removeKey((due,))
                    stored.remove(due)
                for due in [d for d in new if d > at]:
                    del new[due]
                continue
            n += 1
            if r.recoverable and n <= self.most:
                new[at + self.wait] = n
        for due, attempt in new.items():
            self.handle.registerTimer(due)
            self.waiting.updateValue((due,), (attempt,))
        self.failures.update((n,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        if self.waiting.containsKey((due,)):
            attempt = self.waiting.getValue((due,))[0]
            self.waiting.removeKey((due,))
            yield Row(url=key[0], due=due, attempt=attempt)


def retries(results: DataFrame, most: int = RETRIES, minutes: float = RETRY_MINUTES, late: str = "1 minute") -> DataFrame:
    """Streamed results (url, success, recoverable, at) as retries (url, due, attempt), each once its time has come; ``due`` in milliseconds.

    A failure that may pass is due again after ``minutes``, up to ``most`` failures in a row; a success before that calls it off. Time is that of the
    results, less ``late``, so a stream that stops holds what is not due yet, and one that starts again goes on.
    """
    rows = results.withWatermark("at", late)
    return rows.groupBy("url").transformWithState(Retrying(most, minutes), "url string, due long, attempt int", "append", "EventTime")


class Claiming(StatefulProcessor):
    """Of a shard: URLs that wait, that are in work with the batch that took them, and that are done."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.queued = handle.getMapState("queued", "url string", "queue int, priority int")
        self.taken = handle.getMapState("taken", "url string", "batch long")
        self.done = handle.getMapState("done", "url string", "batch long")

    def ahead(self, most: int) -> list[tuple[int, int, str]]:
        """The best ``most`` that wait, as a heap: the queue is read once, whatever its order, and no more of it is held."""
        return heapq.nsmallest(most, ((q, -p, u) for (u,), (q, p) in self.queued.iterator()))

    def waits(self, place: int, priority: int, url: str) -> bool:
        """Whether a place in the heap still holds; a better place or a claim has ended others."""
        return self.queued.containsKey((url,)) and tuple(self.queued.getValue((url,))) == (place, -priority)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rows = sorted(rows, key=lambda r: r.arrival)
        # What a micro-batch's claims can take stands ahead; what is queued after the first of them is pushed beside it.
        wanted, best = sum(r.size for r in rows if r.kind == "claim"), None
        for r in rows:
            url = (r.url,)
            if r.kind == "add":
                if not (self.taken.containsKey(url) or self.done.containsKey(url)):
                    place = QUEUE_ORDER.index(r.queue)
                    known = self.queued.getValue(url) if self.queued.containsKey(url) else None
                    if known is None or (place, -r.priority) < (known[0], -known[1]):
                        self.queued.updateValue(url, (place, r.priority))
                        if best is not None:
                            heapq.heappush(best, (place, -r.priority, r.url))
            elif r.kind in ("done", "back"):
                if self.taken.containsKey(url):
                    batch = self.taken.getValue(url)
                    self.taken.removeKey(url)
                    if r.kind == "done":
                        self.done.updateValue(url, batch)
                    else:
                        self.queued.updateValue(url, (QUEUE_ORDER.index(r.queue), r.priority))
                        if best is not None:
                            heapq.heappush(best, (QUEUE_ORDER.index(r.queue), -r.priority, r.url))
            elif r.kind == "claim":
                best, position = self.ahead(wanted) if best is None else best, 0
                while best and position < r.size:
                    place, priority, u = heapq.heappop(best)
                    if self.waits(place, priority, u):
                        position += 1
                        self.queued.removeKey((u,))
                        self.taken.updateValue((u,), (r.batch,))
                        yield Row(shard=key[0], batch=r.batch, position=position, url=u)


def claims(messages: DataFrame) -> DataFrame:
    """Streamed messages (shard, kind, url, queue, priority, batch, size, arrival) as claimed URLs (shard, batch, position, url).

    ``add`` queues a URL unless it is in work or done, under its better place if it is queued; ``claim`` takes the best ``size`` of the shard for ``batch``: by
    queue, highest priority, URL; ``done`` ends a claimed URL and ``back`` queues it again. No URL is with two batches at a time, and a batch that is worked on again gives
    the same URLs.
    """
    return messages.groupBy("shard").transformWithState(Claiming(), "shard int, batch long, position int, url string", "append", "None")


def start_states(stream: DataFrame, out: str, checkpoint: str, **trigger):
    """Writes a stateful stream's rows by batch, so that a batch that runs again replaces its own."""
    with rocks(stream.sparkSession):
        return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/micro_batch={i}")).trigger(**(trigger or {"availableNow": True})).start()
