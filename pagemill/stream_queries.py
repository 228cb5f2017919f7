"""Queries of the trigram index, of topics with offsets, of binary records and of stateful streams, with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .queries import CR, _folder, query
from .sources import adapters as A

_TITLE = r"regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1, 'is')"
_GRAMS = r"list_distinct(flatten(list_transform(regexp_extract_all(lower(title), '[\p{L}\p{N}]+'), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


@query(f"""with t as (select page_id, {_TITLE} as title from pages), g as (select page_id, {_GRAMS} as g from t),
 p as (select q.page_id as query_id, r.page_id as id, len(list_intersect(q.g, r.g)) as k, len(q.g) as n, len(r.g) as m from g q, g r where q.page_id % 20 = 0 and len(q.g) > 0 and len(r.g) > 0)
 select query_id, id, k / (n + m - k)::double as similarity from p where k / (n + m - k)::double >= 0.3""")
def title_similar(spark, d):
    """Titles alike to every twentieth page's, by an index that is stored in two batches."""
    from .operators.trigrams import TrigramIndex

    titles = A.raw_pages(spark, d).select(F.col("page_id").alias("id"), F.regexp_extract("html", r"(?is)<title[^>]*>([^<]*)</title>", 1).alias("title"))
    index = TrigramIndex(spark, _folder(spark, "trigrams"))
    for k in (0, 1):
        index.add(titles.where(f"id % 2 = {k}"), f"b{k}")
    return index.search(titles.where("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("title").alias("text")))


def _vector_index(spark, d):
    """The stored inverted file over all vectors, in two batches, and every twentieth vector as queries."""
    from .operators.vector_index import VectorIndex

    rows = A.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    index = VectorIndex(spark, _folder(spark, "vectors"))
    index.train(rows)
    for k in (0, 1):
        index.add(rows.where(f"id % 2 = {k}"), f"b{k}")
    return index, rows.where("id % 20 = 0").select(F.col("id").alias("query_id"), "embedding")


@query()
def vector_index_search(spark, d):
    """The ten nearest by as many lists as the sample needs for 0.95 of them; recall is measured in the tests."""
    index, queries = _vector_index(spark, d)
    return index.search(queries).withColumn("similarity", F.round("similarity", 6))


@query("""with v as (select vec_id as id, embedding::double[] as e from embeddings), p as (select a.id as query_id, b.id, list_cosine_similarity(a.e, b.e) as s from v a, v b where a.id % 20 = 0)
 select query_id, id, round(s, 6) as similarity from p qualify row_number() over (partition by query_id order by s desc, id) <= 10""")
def vector_index_all_lists(spark, d):
    """The same index with every list read: the exact ten nearest."""
    index, queries = _vector_index(spark, d)
    return index.search(queries, probes=len(index.model[0])).withColumn("similarity", F.round("similarity", 6))


#: Rows of a commit, where a stream's outcomes do not depend on how it is cut: what a micro-batch holds is bounded by it.
COMMIT_ROWS = 1_000_000


def _in_turn(spark: SparkSession, name: str, rows: DataFrame, start, most: int | None = None) -> DataFrame:
    """Rows (arrival, ...) as messages of a topic that come in several commits; ``start(messages, out, checkpoint)`` runs after each, from its checkpoint. What it wrote."""
    from .functions.msgpack import decode, encode
    from .sources import topics

    root = _folder(spark, name)
    last = rows.agg(F.max("arrival")).first()[0] or 0
    most = most or max(2, -(-(last + 1) // COMMIT_ROWS))  # arrivals are numbers without large gaps
    keyed = rows.withColumns({"_key": F.col(rows.columns[0]).cast("string"), "_time": F.current_timestamp()})
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    for k in range(most):
        first, end = (-(-i * (last + 1) // most) for i in (k, k + 1))  # bounds that a scan skips row groups by
        part = keyed.where((F.col("arrival") >= first) & (F.col("arrival") < end)).repartition(spark.sparkContext.defaultParallelism)
        topics.produce(encode(part.select("_key", "_time", *rows.columns), "value", ("_key", "_time")).withColumnsRenamed({"_key": "key", "_time": "time"}), root, "messages")
        messages = decode(topics.consume(spark, root, "messages", name), "value", ddl).where("error is null").select("record.*")
        start(messages, f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query("select r.role, event_id, user_id::varchar as key, count(*) over (partition by r.role, user_id) as of_key from events, (select unnest(['router', 'storage']) as role) r")
def topic_by_role(spark, d):
    """Two groups that read one topic from the earliest; one of them starts anew between two commits."""
    from .sources import topics

    root, events = _folder(spark, "topic"), A.table(spark, d, "events")
    rows = events.select("event_id", F.col("user_id").cast("string").alias("key"), F.col("event_id").cast("string").cast("binary").alias("value"), F.col("ts").cast("timestamp").alias("time"))

    def run(role: str, checkpoint: str):
        got = topics.consume(spark, root, "events", role)
        got.writeStream.option("checkpointLocation", f"{root}/state-{checkpoint}").foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{root}/{role}/run={checkpoint}-{i}")).trigger(availableNow=True).start().awaitTermination()

    for k in (0, 1):
        topics.produce(rows.where(f"event_id % 2 = {k}"), root, "events")
        run("router", "router")
    run("storage", "storage")
    parts = [spark.read.parquet(f"{root}/{role}").select(F.lit(role).alias("role"), F.col("value").cast("string").cast("long").alias("event_id"), "key") for role in ("router", "storage")]
    both = parts[0].union(parts[1])
    return both.join(both.groupBy("role", "key").agg(F.count("*").alias("of_key")), ["role", "key"]).select("role", "event_id", "key", "of_key")


@query("""select event_id, ts, user_id, event_type as kind, case when event_id % 5 <> 0 then value end as value, [event_id, -event_id, event_id * 1000003] as numbers, event_type as tag, user_id * 1.5 as weight, encode(props) as raw, null as error from events where event_id % 17 <> 0
 union all select event_id, null, null, null, null, null, null, null, null, case when event_id % 2 = 0 then 'ends early' else 'more than a record' end from events where event_id % 17 = 0""")
def packed_messages(spark, d):
    """Events as binary records of nested values, and back; every seventeenth is broken and tells why."""
    from .functions.msgpack import decode, encode

    e = A.table(spark, d, "events")
    value = F.when(F.col("event_id") % 5 != 0, F.col("value"))
    body = F.struct(F.array(F.col("event_id"), -F.col("event_id"), F.col("event_id") * 1000003).alias("numbers"), F.create_map(F.col("event_type"), F.col("user_id") * 1.5).alias("weights"), F.col("props").cast("binary").alias("raw"))
    rows = e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", F.col("event_type").alias("kind"), value.alias("value"), body.alias("body"))
    sent = encode(rows, "message", ("event_id",)).withColumnRenamed("event_id", "id")
    whole = F.col("message")
    sent = sent.withColumn("message", F.when(F.col("id") % 34 == 0, F.expr("substring(message, 1, length(message) - 1)")).when(F.col("id") % 17 == 0, F.concat(whole, whole)).otherwise(whole))
    ddl = "event_id long, ts timestamp, user_id long, kind string, value double, body struct<numbers:array<long>, weights:map<string,double>, raw:binary>"
    r, body = F.col("record"), F.col("record.body")
    got = decode(sent, "message", ddl)
    return got.select(F.col("id").alias("event_id"), r["ts"].cast("timestamp_ntz").alias("ts"), r["user_id"].alias("user_id"), r["kind"].alias("kind"), r["value"].alias("value"), body["numbers"].alias("numbers"), F.map_keys(body["weights"])[0].alias("tag"), F.map_values(body["weights"])[0].alias("weight"), body["raw"].alias("raw"), "error")


@query("""with e as (select event_id as arrival, 'd' || user_id % 23 as domain, 'u' || (event_id * 7919) % 997 % 400 as url, case when event_id % 3 = 0 then 's' || event_id % 2 end as seed, event_id % 5 as depth, event_id % 500 = 499 as reset from events),
 p as (select *, sum(reset::int) over (partition by domain order by arrival) as era from e), u as (select * from p where not reset),
 ok as (select *, seed is null or depth <= 3 as fits from u), f as (select *, min(arrival) filter (where fits) over (partition by domain, era, url) as first from ok)
 select domain, count(*) as n, count(*) filter (where not fits and (first is null or arrival < first)) as too_deep, count(*) filter (where arrival = first) as firsts from f group by domain""")
def stream_discovery(spark, d):
    """Outcomes of discovered URLs by one stateful operator, counted per domain; caps are beyond what these rows reach, resets happen."""
    from .streaming import states

    e = A.table(spark, d, "events")
    reset = F.col("event_id") % 500 == 499
    rows = e.select(F.concat(F.lit("d"), F.col("user_id") % 23).alias("domain"), F.when(reset, "reset").otherwise("url").alias("kind"), F.concat(F.lit("u"), (F.col("event_id") * 7919) % 997 % 400).alias("url"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("s"), F.col("event_id") % 2)).alias("seed"), (F.col("event_id") % 5).alias("depth"), F.lit(3).cast("long").alias("max_depth"), F.lit(1_000_000_000).cast("long").alias("max_pages"), F.col("event_id").alias("arrival"))
    got = _in_turn(spark, "discovery", rows, lambda m, out, c: states.start_states(states.discover(m, 1_000_000_000), out, c)).where("outcome <> 'reset'")
    return got.groupBy("domain").agg(F.count("*").alias("n"), F.count_if(F.col("outcome") == "scope_depth_limit").alias("too_deep"), F.count_if(F.col("outcome") == "added").alias("firsts"))


@query("""with e as (select 'd' || user_id % 23 as domain, event_id as arrival, event_id::varchar as url, case when event_id % 3 = 0 then 's' || event_id % 2 end as seed from events),
 n as (select *, row_number() over (partition by domain, seed order by arrival) as k from e)
 select domain, url, case when seed is null and k > 40 then 'domain_limit' when seed is not null and k > 25 then 'scope_page_limit' else 'added' end as outcome, case when seed is not null and k <= 25 then k end as pages from n""")
def stream_caps(spark, d):
    """Caps of domains and of seeds over a whole stream that stops and goes on."""
    from .streaming import states

    e = A.table(spark, d, "events")
    rows = e.select(F.concat(F.lit("d"), F.col("user_id") % 23).alias("domain"), F.lit("url").alias("kind"), F.col("event_id").cast("string").alias("url"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("s"), F.col("event_id") % 2)).alias("seed"), F.lit(0).cast("long").alias("depth"), F.lit(3).cast("long").alias("max_depth"), F.lit(25).cast("long").alias("max_pages"), F.col("event_id").alias("arrival"))
    got = _in_turn(spark, "caps", rows, lambda m, out, c: states.start_states(states.discover(m, 40), out, c))
    return got.select("domain", "url", "outcome", "pages")


@query("""with e as (select 'p' || user_id as url, event_type <> 'error' as success, event_id % 4 <> 0 as recoverable, event_id, epoch_us(ts) // 1000 as t from events),
 r as (select *, sum(success::int) over (partition by url order by t, event_id) as era from e), f as (select *, row_number() over (partition by url, era order by t, event_id) as attempt from r where not success),
 w as (select url, t + 1800000 as due, attempt::int as attempt from f where recoverable and attempt <= 3)
 select w.* from w where due <= (select max(t) - 60000 from e where event_id * 2 < (select max(event_id) + 1 from e)) and not exists (from e where e.url = w.url and e.success and e.t < w.due and e.t >= w.due - 1800000)""")
def stream_retries(spark, d):
    """Retries whose timers have run out, over a stream that stops and goes on. A batch's clock is what the batches before have seen."""
    from .streaming import states

    e = A.table(spark, d, "events")
    rows = e.select(F.concat(F.lit("p"), "user_id").alias("url"), (F.col("event_type") != "error").alias("success"), (F.col("event_id") % 4 != 0).alias("recoverable"), F.date_trunc("millisecond", F.col("ts").cast("timestamp")).alias("at"), F.col("event_id").alias("arrival"))
    return _in_turn(spark, "retries", rows, lambda m, out, c: states.start_states(states.retries(m), out, c), 2).select("url", "due", "attempt")


_ADDED = "a as (select page_id, (page_id % 3)::int as shard, 'u' || page_id as url, (page_id % 5)::int as place, (page_id * 37 % 101)::int as priority from pages)"


@query(f"with {_ADDED}, r as (select shard, url, row_number() over (partition by shard order by place, priority desc, url) as k from a) select shard, (((k - 1) // 7) + (select min(page_id) // 3 from pages p where p.page_id % 3 = r.shard))::bigint as batch, ((k - 1) % 7 + 1)::int as position, url from r")
def stream_claims(spark, d):
    """Batches of seven that shards give until their queues are empty: every URL once, best first."""
    from .operators.frontier import QUEUE_ORDER
    from .streaming import states

    p = A.raw_pages(spark, d).select("page_id")
    place = F.array(*map(F.lit, QUEUE_ORDER))[(F.col("page_id") % 5).cast("int")]
    none = F.lit(None)
    adds = p.select((F.col("page_id") % 3).cast("int").alias("shard"), F.lit("add").alias("kind"), F.concat(F.lit("u"), "page_id").alias("url"), place.alias("queue"), (F.col("page_id") * 37 % 101).cast("int").alias("priority"), none.cast("long").alias("batch"), none.cast("int").alias("size"), F.col("page_id").alias("arrival"))
    # As many claims as pages are more than enough; those of an empty queue give nothing.
    last = p.agg(F.max("page_id")).first()[0] or 0
    ask = p.select((F.col("page_id") % 3).cast("int").alias("shard"), F.lit("claim").alias("kind"), none.cast("string").alias("url"), none.cast("string").alias("queue"), none.cast("int").alias("priority"), F.expr("page_id div 3").alias("batch"), F.lit(7).alias("size"), (F.col("page_id") + last + 1).alias("arrival"))
    return _in_turn(spark, "claims", adds.union(ask), lambda m, out, c: states.start_states(states.claims(m), out, c)).select("shard", "batch", "position", "url")


@query(f"with {CR} select * from (select 'processed_total' as name, count(*)::double as value from cr union all select 'succeeded_total', sum(success::int)::double from cr union all select 'failed_total', sum((not success)::int)::double from cr union all select 'seconds_total', round(sum(response_time), 3) from cr)")
def stream_statistics(spark, d):
    """Counters that a stream over all results told with its batches, in several runs of the same query."""
    from .plans import metrics
    from .streaming import statistics

    root = _folder(spark, "statistics")
    A.crawl_results(spark, d).repartition(6, "id").write.parquet(f"{root}/in")
    listener = statistics.RunStatistics(spark, f"{root}/told", "results")
    spark.streams.addListener(listener)
    try:
        rows = spark.readStream.schema(spark.read.parquet(f"{root}/in").schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
        seen = statistics.observed(rows, "results", statistics.result_metrics())
        seen.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start().awaitTermination()
        listener.done.wait(60)
    finally:
        spark.streams.removeListener(listener)
    return metrics.instant(statistics.samples(spark, f"{root}/told"), []).withColumn("value", F.round("value", 3))
