"""The URL frontier: priorities, sharded queues, discovered URLs, caps, batches, rebalancing, completion.

Queues are one table (shard, queue, priority, url, ...); state is one table (url_hash, state). What a key-value
store checks one URL at a time are anti-joins on the hash here. Caps number arrivals within a domain after
duplicates are gone, so they never depend on timing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

#: Priorities, caps and limits of the frontier.
DISCOVERED_PRIORITY, CUSTOM_PRIORITY, SEED_PRIORITY, RETRY_PRIORITY = 600, 850, 850, 500
MOST_PER_DOMAIN, MOST_PENDING, PER_QUEUE, RETRIES, RETRY_MINUTES, DUE = 100, 5_000_000, 20, 3, 30, 20
QUEUE_ORDER = ("priority_high", "priority_custom", "priority_medium", "priority_normal", "priority_low")


def queue_rank(queue: Column | str = "queue") -> Column:
    q = F.col(queue) if isinstance(queue, str) else queue
    return F.array_position(F.array(*map(F.lit, QUEUE_ORDER)), q)


def prepare(ranks: DataFrame, shards: int, count: int | None = None) -> DataFrame:
    """Queue rows of a rank list (rank, domain), best first; at most ``count`` of them."""
    rows = ranks.orderBy("rank").limit(count) if count is not None else ranks
    url = S.domain_url("domain")
    priority = S.rank_priority("rank")
    return rows.select(S.shard_of_url(url, shards).alias("shard"), S.queue_of(priority, F.lit("root")).alias("queue"), priority.alias("priority"), url.alias("url"), "domain", "rank", F.lit("root").alias("url_type"))


def ordered(rows: DataFrame) -> DataFrame:
    """Highest priority first, then rank."""
    return rows.orderBy(F.desc("priority"), "rank")


def rank_lines(rows: DataFrame) -> DataFrame:
    """The text form ``priority,rank,domain,url,type``."""
    return ordered(rows).select(F.concat_ws(",", "priority", "rank", "domain", "url", "url_type").alias("value"))


def without_known(urls: DataFrame, completed: DataFrame, pending: DataFrame) -> DataFrame:
    """Rows (url, ...) with ``outcome``: dedup_completed, then dedup_pending, else null. Both tables hold url_hash."""
    rows = urls.withColumn("url_hash", S.url_hash("url"))
    done = completed.select("url_hash").distinct().withColumn("_done", F.lit(True))
    wait = pending.select("url_hash").distinct().withColumn("_wait", F.lit(True))
    rows = rows.join(done, "url_hash", "left").join(wait, "url_hash", "left")
    return rows.withColumn("outcome", F.when(F.col("_done"), "dedup_completed").when(F.col("_wait"), "dedup_pending")).drop("_done", "_wait")


#: Buckets into which a hot key's rows are dealt before the few that are left meet.
SALT = 32


def _first_of(rows: DataFrame, key: str, most: Column, outcome: str, arrival: str, before: Column | int = 0) -> DataFrame:
    """Rows without an outcome beyond a key's first ``most`` by arrival get ``outcome``; ``_nth`` numbers the others.

    A running number needs a key's rows in order. So that one huge key is no single task, rows that can't
    be among them are refused first: within hash buckets of a key only the first ``most`` can be among the
    first ``most`` of the whole key. The second numbering then sees at most buckets times ``most`` rows of a
    key together; refused ones stay in their buckets.
    """
    salt, new = F.pmod(F.xxhash64("url", arrival), F.lit(SALT)), F.col("outcome").isNull()
    within = F.row_number().over(Window.partitionBy(key, salt, new).orderBy(arrival))
    rows = rows.withColumn("outcome", F.when(new & (within > most), outcome).otherwise(F.col("outcome")))
    nth = F.row_number().over(Window.partitionBy(key, F.when(new, F.lit(-1)).otherwise(salt)).orderBy(arrival))
    return rows.withColumn("_nth", nth + before).withColumn("outcome", F.when(new & (F.col("_nth") > most), outcome).otherwise(F.col("outcome")))


def first_arrivals(rows: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Later arrivals of a new URL count as pending, however many pages link to it."""
    return _first_of(rows, "url_hash", F.lit(1), "dedup_pending", arrival).drop("_nth")


def _capped(rows: DataFrame, key: str, most: Column, counts: DataFrame | None, outcome: str, arrival: str) -> DataFrame:
    """New rows beyond a key's cap get ``outcome``; ``counts`` (key, n) holds what was added before; ``_nth`` counts on from it."""
    before = F.lit(0)
    if counts is not None:
        rows = rows.join(counts.select(key, F.col("n").alias("_before")), key, "left")
        before = F.coalesce("_before", F.lit(0))
    return _first_of(rows, key, most, outcome, arrival, before).drop("_before")


def add_discovered(urls: DataFrame, completed: DataFrame, pending: DataFrame, shards: int, domain_counts: DataFrame | None = None, most: int = MOST_PER_DOMAIN) -> DataFrame:
    """Outcomes of discovered URLs (url, source_url, arrival): added, dedup_completed, dedup_pending or domain_limit.

    Added ones carry shard, queue and priority.
    """
    rows = first_arrivals(without_known(urls, completed, pending)).withColumn("domain", S.netloc("url"))
    rows = _capped(rows, "domain", F.lit(most), domain_counts, "domain_limit", "arrival")
    added = F.col("outcome").isNull()
    return rows.withColumns({"shard": F.when(added, S.shard_of_url("url", shards)), "queue": F.when(added, "priority_low"), "priority": F.when(added, DISCOVERED_PRIORITY), "url_type": F.lit("discovered"), "outcome": F.coalesce("outcome", F.lit("added"))}).drop("_nth")


def add_scoped(urls: DataFrame, completed: DataFrame, pending: DataFrame, shards: int, page_counts: DataFrame | None = None) -> DataFrame:
    """Outcomes of URLs with a scope struct and current_depth: the first reason that holds against a URL.

    An added URL carries its scope with its own ``current_depth`` and the number of its seed's pages so far. A path prefix is a plain prefix: ``/news`` lets ``/newsletter`` pass.
    """
    s = F.col("scope")
    rows = first_arrivals(without_known(urls, completed, pending)).withColumn("domain", F.lower(S.netloc("url")))
    allowed = F.lower(F.coalesce(s["allowed_domain"], F.lit("")))
    prefix = F.coalesce(F.nullif(s["path_prefix"], F.lit("")), F.lit("/"))
    prefix = F.when(prefix.startswith("/"), prefix).otherwise(F.concat(F.lit("/"), prefix))
    outside = (allowed == "") | (F.col("domain") != allowed) | ~S.path_of("url").startswith(prefix)
    deep = F.col("current_depth") > F.coalesce(s["max_depth"], F.lit(3))
    seed = F.coalesce(F.nullif(s["seed_url"], F.lit("")), F.concat(F.lit("https://"), allowed, prefix))
    rows = rows.withColumn("outcome", F.coalesce("outcome", F.when(outside, "scope_filtered").when(deep, "scope_depth_limit"))).withColumn("seed_url", seed)
    rows = _capped(rows, "seed_url", F.coalesce(s["max_pages"], F.lit(10000)), page_counts, "scope_page_limit", "arrival")
    added, names = F.col("outcome").isNull(), urls.schema["scope"].dataType.names

    def new(field: str, value: Column) -> Column:
        return F.when(added, value.cast("long")).otherwise(s[field].cast("long") if field in names else F.lit(None))

    return rows.withColumns({"shard": F.when(added, S.shard_of_url("url", shards)), "queue": F.when(added, "priority_custom"), "priority": F.when(added, CUSTOM_PRIORITY), "url_type": F.lit("custom"), "outcome": F.coalesce("outcome", F.lit("added")), "scope": s.withField("current_depth", new("current_depth", F.col("current_depth"))).withField("pages_crawled", new("pages_crawled", F.col("_nth")))}).drop("_nth")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Counts as the consumer reports them; URLs that don't normalise and repeats are one figure, invalid_or_dup."""
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n"))


def add_seeds(seeds: DataFrame, completed: DataFrame, shards: int, max_depth: int = 3, max_pages: int = 10000) -> DataFrame:
    """Queue rows of seed URLs (url) that are not completed, with their scope."""
    rows = seeds.withColumn("url_hash", S.url_hash("url")).join(completed.select("url_hash").distinct(), "url_hash", "left_anti").dropDuplicates(["url_hash"])
    domain = S.netloc("url")
    scope = F.struct(F.col("url").alias("seed_url"), domain.alias("allowed_domain"), S.path_of("url").alias("path_prefix"), F.lit(max_depth).alias("max_depth"), F.lit(max_pages).alias("max_pages"), F.lit(0).alias("current_depth"), F.lit(0).alias("pages_crawled"))
    return rows.select(S.shard_of_url("url", shards).alias("shard"), F.lit("priority_custom").alias("queue"), F.lit(SEED_PRIORITY).alias("priority"), "url", domain.alias("domain"), F.lit("custom").alias("url_type"), scope.alias("scope"))


def next_batch(queues: DataFrame, size: int = 50, seed: int = 0, per_queue: int = PER_QUEUE) -> DataFrame:
    """The next URLs: shards in an order that ``seed`` shuffles, queues in order, highest priority first.

    A queue gives at most ``per_queue`` and at most what is still wanted. Each queue keeps its best few by a
    ranked limit, so that only shards times queues times ``per_queue`` rows meet in one place.
    """
    w = Window.partitionBy("shard", "queue").orderBy(F.desc("priority"), F.desc("url"))
    best = queues.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= min(size, per_queue))
    order = [F.xxhash64(F.col("shard"), F.lit(seed)), queue_rank(), F.col("_r")]
    return best.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order))).where(F.col("position") <= size).drop("_r")


def next_unsharded(queue: DataFrame, size: int) -> DataFrame:
    return queue.orderBy(queue_rank(), F.desc("priority"), F.desc("url")).limit(size)


def due_retries(retries: DataFrame, now: float, n: int = DUE) -> DataFrame:
    """Retries (url, due) whose time has come, earliest first."""
    return retries.where(F.col("due") <= now).orderBy("due", "url").limit(n).withColumn("priority", F.lit(RETRY_PRIORITY))


def shard_loads(queues: DataFrame, processing: DataFrame, shards: int) -> DataFrame:
    """(shard, load): queued and processing URLs, 0 for an empty shard."""
    all_ = queues.select("shard").unionByName(processing.select("shard")).groupBy("shard").agg(F.count("*").alias("load"))
    return queues.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(all_, "shard", "left").fillna(0, ["load"])


def rebalance(queues: DataFrame, processing: DataFrame, shards: int, batch: int = 100) -> DataFrame:
    """``queues`` with some rows on another shard, and ``moved``.

    Shards over 1.5 times the mean give to the least loaded one if that is under half the mean: up to ten of
    the lowest priority from the low queue, then from the normal one, within a quarter of ``batch``.
    """
    one = Window.partitionBy(F.lit(1))
    loads = shard_loads(queues, processing, shards).withColumn("mean", F.avg("load").over(one)).withColumn("least", F.min(F.struct("load", "shard")).over(one))
    gives = loads.where((F.col("load") > F.col("mean") * 1.5) & (F.col("least.load") < F.col("mean") * 0.5)).select("shard", F.col("least.shard").alias("_to"))
    rank = F.row_number().over(Window.partitionBy("shard", "queue").orderBy("priority", "url"))
    budget = batch // 4
    low = F.least(F.lit(min(budget, 10)), F.sum(F.when(F.col("queue") == "priority_low", 1).otherwise(0)).over(Window.partitionBy("shard")))
    can = queues.join(F.broadcast(gives), "shard").where(F.col("queue").isin("priority_low", "priority_normal"))  # a row per shard at most
    can = can.withColumn("_r", rank).withColumn("_low", low)
    picked = can.where(((F.col("queue") == "priority_low") & (F.col("_r") <= F.col("_low"))) | ((F.col("queue") == "priority_normal") & (F.col("_r") <= F.least(F.lit(10), F.lit(budget) - F.col("_low")))))
    chosen = picked.select("url", F.col("shard").alias("_from"), F.col("queue").alias("_queue"), "_to").withColumn("moved", F.lit(True))
    out = queues.join(chosen, (queues.url == chosen.url) & (queues.shard == chosen._from) & (queues.queue == chosen._queue), "left").drop(chosen.url, "_from", "_queue")
    return out.withColumn("shard", F.coalesce("_to", "shard")).withColumn("moved", F.coalesce("moved", F.lit(False))).drop("_to")


def queue_stats(queues: DataFrame, states: DataFrame) -> DataFrame:
    """Per shard: a column per queue and state, total pending and success rate; the null shard sums all."""
    long = queues.select("shard", F.col("queue").alias("what")).unionByName(states.select("shard", F.col("state").alias("what")))
    g = long.groupBy("shard").pivot("what", [*QUEUE_ORDER, "processing", "completed", "failed"]).agg(F.count(F.lit(1))).fillna(0)
    cols = [*QUEUE_ORDER, "processing", "completed", "failed"]
    g = g.unionByName(g.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols)).withColumn("shard", F.lit(None).cast("int")))
    total = sum((F.col(c) for c in QUEUE_ORDER), F.lit(0))
    return g.withColumn("total_pending", total).withColumn("success_rate", F.round(S.ratio(F.col("completed"), F.col("completed") + F.col("failed"), 100.0), 2))


def domain_summary(states: DataFrame, n: int = 20) -> DataFrame:
    """Domains by what was tried: completed, failed, total, rate."""
    g = states.groupBy("domain").agg(F.count_if(F.col("state") == "completed").alias("success"), F.count_if(F.col("state") == "failed").alias("failed"))
    g = g.withColumn("total", F.col("success") + F.col("failed"))
    return g.withColumn("success_rate", F.round(S.ratio(F.col("success"), F.col("total"), 100.0), 2)).orderBy(F.desc("total"), "domain").limit(n)


def mark_completed(states: DataFrame, results: DataFrame, now: float) -> DataFrame:
    """States after results (url_hash, success, recoverable): completed, or failed with a retry due.

    A failure that may pass is due again after half an hour until it has been tried three times.
    """
    r = results.groupBy("url_hash").agg(F.max("success").alias("_ok"), F.max("recoverable").alias("_rec"))
    out = states.join(r, "url_hash", "left")
    hit = F.col("_ok").isNotNull() & (F.col("state") == "processing")
    failed = hit & ~F.col("_ok")
    attempts = F.coalesce("attempts", F.lit(0)) + F.when(failed, 1).otherwise(0)
    state = F.when(hit & F.col("_ok"), "completed").when(failed, "failed").otherwise(F.col("state"))
    due = F.when(failed & F.col("_rec") & (attempts <= RETRIES), F.lit(float(now) + RETRY_MINUTES * 60)).otherwise(F.col("due"))
    return out.withColumns({"state": state, "due": due, "attempts": attempts}).drop("_ok", "_rec")


def cleanup(states: DataFrame, now: float, hours: float = 24) -> DataFrame:
    """Failures older than so many hours go."""
    return states.where(~((F.col("state") == "failed") & (F.col("changed") < now - hours * 3600)))


def domain_delays(domains: DataFrame, delays: DataFrame, default: float = 1.0) -> DataFrame:
    return domains.join(delays.select("domain", "delay"), "domain", "left").withColumn("delay", F.coalesce("delay", F.lit(default)))


def backpressure(total_pending: int, most: int = MOST_PENDING) -> bool:
    """Whether new URLs must wait."""
    return total_pending >= most
