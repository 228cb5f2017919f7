"""Queries of sources, sinks, states and extraction that write before they read, and a fixed set of pages whose results are written out."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import frontier, merge
from .plans import reports
from .queries import _KEY, _NET, CR, HOURS, PAGES, _folder, query
from .sources import adapters as A
from .sources import readers

# --- files -----------------------------------------------------------------------------------------------


@query(f"""with r as (select page_id + 1 as rank, {_NET} as domain from pages), p as (select *, case when rank <= 100 then 1000 when rank <= 1000 then 900 when rank <= 10000 then 800 when rank <= 100000 then 700 else 600 end as priority from r)
 select priority || ',' || rank || ',' || domain || ',https://' || domain || '/,root' as line from p""")
def rank_file(spark, d):
    """A rank list with broken lines, read from CSV, queued and written as lines."""
    from .functions.scalars import netloc

    out = _folder(spark, "ranks")
    ranks = A.raw_pages(spark, d).select(F.concat_ws(",", F.col("page_id") + 1, netloc("url")).alias("value"))
    ranks.unionByName(spark.createDataFrame([("no number,a.b",)], "value string")).write.text(out + "/in")
    readers.write_rank_lines(frontier.rank_lines(frontier.prepare(readers.rank_list(spark, out + "/in"), 3)), out + "/out")
    return spark.read.text(out + "/out").select(F.col("value").alias("line"))


@query("select url from pages")
def url_file(spark, d):
    out = _folder(spark, "urls")
    A.raw_pages(spark, d).select(F.explode(F.array(F.concat(F.lit(" "), "url", F.lit(" ")), F.lit(" "))).alias("value")).write.text(out)
    return readers.url_list(spark, out)


@query(f"select distinct 'https://' || {_NET} || '/s' as url from pages")
def seed_file(spark, d):
    """Seeds in a file with comments and blank lines, each once."""
    from .functions.scalars import netloc

    out = _folder(spark, "seeds")
    A.raw_pages(spark, d).select(F.explode(F.array(F.concat(netloc("url"), F.lit("/s?x=1#y")), F.lit("# a comment"), F.lit(""))).alias("value")).write.text(out)
    return readers.seed_list(spark, out)


@query("select * from (values (4::bigint, 2::bigint, 1::bigint, 1::bigint, 50.0::double, 2.5::double)) t(total, passed, failed, skipped, pass_rate, seconds)", fixed=True)
def test_report_summary(spark, d):
    out = _folder(spark, "report")
    tests = [("a", "passed", 0.5), ("b", "passed", 1.0), ("c", "failed", 1.0), ("d", "skipped", 0.0)]
    found = ",".join(f'{{"name":"{n}","status":"{s}","duration":{t}}}' for n, s, t in tests)
    spark.createDataFrame([(f'{{"tests":[{found}]}}',)], "value string").coalesce(1).write.text(out)
    return readers.test_summary(readers.test_report(spark, out))


_OBJECTS = f"{PAGES}, o as (select pg.*, 'body of ' || id as content from pg where id % 3 <> 1)"


def _stored(spark, d):
    p, out = A.pages(spark, d), _folder(spark, "objects")
    readers.store_objects(p.where("id % 3 <> 1").select(F.col("markdown_key").alias("key"), "url", F.concat(F.lit("body of "), "id").alias("content")), out)
    return p, spark.read.parquet(out)


@query(f"with {_OBJECTS} select markdown_key as key, content, strlen(content)::bigint as original_size, 'text/markdown' as content_type from o")
def stored_objects(spark, d):
    return _stored(spark, d)[1].select("key", "content", F.col("original_size").cast("long").alias("original_size"), "content_type")


@query(f"with {_OBJECTS} select pg.id, pg.domain, o.content as markdown from pg left join o using (markdown_key) where pg.url = (select url from pages where page_id = 9)")
def page_content(spark, d):
    """One page by its URL, with its stored text."""
    p, o = _stored(spark, d)
    return readers.page_with_content(p, o, A.raw_pages(spark, d).where("page_id = 9").first().url).select("id", "domain", "markdown")


@query(f"with {_OBJECTS} select id from o")
def existing_objects(spark, d):
    """Pages whose own text is stored; pages with one URL share a key."""
    p, o = _stored(spark, d)
    return readers.objects_exist(p.select("id", F.col("markdown_key").alias("key"), F.concat(F.lit("body of "), "id").alias("content")), o).select("id")


@query("select page_id, html from pages where page_id % 3 <> 0")
def raw_html_kept(spark, d):
    """Compressed messages, plain ones and empty ones; the empty ones go."""
    p, k = A.raw_pages(spark, d), F.col("page_id") % 3
    m = p.select("page_id", readers.compress(F.when(k == 1, F.col("html"))).alias("html_compressed"), F.when(k == 2, F.col("html")).otherwise(F.when(k == 0, "")).alias("html"))
    return readers.raw_html(m).select("page_id", "html")


@query(f"with {CR} select sink, count(*) as n, min(id) as first, max(id) as last from (select id, case when success then 'good' else 'bad' end as sink from cr union all select id, 'slow' from cr where response_time > 0.5) group by sink")
def fanned_out(spark, d):
    """A batch written to three sinks at once, and read from them."""
    from .streaming.pipeline import fan_out

    out, sinks = _folder(spark, "fan"), {"good": lambda b: b.where("success"), "bad": lambda b: b.where("not success"), "slow": lambda b: b.where("response_time > 0.5")}
    fan_out(A.crawl_results(spark, d), sinks, out, 0)
    parts = [spark.read.parquet(f"{out}/{k}").select(F.lit(k).alias("sink"), "id") for k in sinks]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("sink").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))


# --- tables and states -----------------------------------------------------------------------------------


@query(f"with {PAGES}, h as ({HOURS}) select stat_hour, total_processed, fast_processed, rich_processed from h")
def upserted_hours(spark, d):
    """Hourly counters of even pages grow by those of odd ones."""
    p = A.pages(spark, d)
    even, odd = (reports.hourly_crawl_stats(p.where(f"id % 2 = {k}")) for k in (0, 1))
    return merge.upsert_hourly(even, odd).select("stat_hour", "total_processed", "fast_processed", "rich_processed")


@query(f"""with {CR}, t as (select distinct domain as url, 'old' as title from cr where id % 2 = 0), n as (select domain as url, arg_min('new ' || id, (crawl_time, id)) as title from cr where id % 2 = 1 or id % 3 = 0 group by domain)
 select coalesce(t.url, n.url) as url, coalesce(n.title, t.title) as title from t full join n on t.url = n.url""")
def upserted_crawled(spark, d):
    """The older page table: the first arrival of a batch overwrites."""
    c = A.crawl_results(spark, d)
    target = c.where("id % 2 = 0").select(F.col("domain").alias("url")).distinct().select("url", F.lit("old").alias("title"), F.lit(None).cast("struct<t:timestamp,id:bigint>").alias("created_at"))
    batch = c.where("id % 2 = 1 or id % 3 = 0").select(F.col("domain").alias("url"), F.concat(F.lit("new "), "id").alias("title"), F.struct(F.col("crawl_time").cast("timestamp").alias("t"), "id").alias("created_at"))
    return merge.upsert_crawled(target, batch).select("url", "title")


@query(f"select distinct 'https://' || {_NET} || '/' as url, {_NET} as domain, 'priority_custom' as queue, 850 as priority from pages where md5('https://' || {_NET} || '/') not in (select md5('https://' || {_NET} || '/') from pages where page_id % 4 = 0)")
def queued_seeds(spark, d):
    """Seeds that were not completed before, each once."""
    from .functions import scalars as S

    seeds = A.raw_pages(spark, d).select("page_id", S.domain_url(S.netloc("url")).alias("url"))
    done = seeds.where("page_id % 4 = 0").select(S.url_hash("url").alias("url_hash"))
    return frontier.add_seeds(seeds.select("url"), done, 3).select("url", "domain", "queue", "priority")


_STATES = "st as (select event_id as h, case event_id % 4 when 0 then 'completed' else 'processing' end as state, (event_id % 5)::int as attempts from events), rs as (select event_id as h, event_id % 3 = 0 as ok, event_id % 2 = 0 as rec from events where event_id % 7 <> 0)"


@query(f"""with {_STATES}, j as (select st.h, st.state, attempts, ok, rec, ok is not null and st.state = 'processing' as hit from st left join rs on rs.h = st.h)
 select h as id, case when hit and ok then 'completed' when hit then 'failed' else state end as state, (attempts + case when hit and not ok then 1 else 0 end)::int as attempts, case when hit and not ok and rec and attempts + 1 <= 3 then 5000.0::double + 1800 end as due from j""")
def completed_states(spark, d):
    """States after results: completed, failed for good, or due again."""
    e, n = A.table(spark, d, "events"), F.col("event_id")
    states = e.select(n.cast("string").alias("url_hash"), F.when(n % 4 == 0, "completed").otherwise("processing").alias("state"), (n % 5).cast("int").alias("attempts"), F.lit(None).cast("double").alias("due"))
    results = e.where("event_id % 7 <> 0").select(n.cast("string").alias("url_hash"), (n % 3 == 0).alias("success"), (n % 2 == 0).alias("recoverable"))
    return frontier.mark_completed(states, results, 5000.0).select(F.col("url_hash").cast("long").alias("id"), "state", "attempts", "due")


@query("select event_id as id from events where not (event_id % 3 = 0 and event_id < 100000 - 24 * 3600)")
def cleaned_states(spark, d):
    e = A.table(spark, d, "events")
    states = e.select("event_id", F.when(F.col("event_id") % 3 == 0, "failed").otherwise("completed").alias("state"), F.col("event_id").cast("double").alias("changed"))
    return frontier.cleanup(states, 100000.0).select(F.col("event_id").alias("id"))


@query("select 'doc:' || doc_id as url from documents where length(text) >= 200")
def eligible_documents(spark, d):
    """Documents long enough for chunks; each gives one at least."""
    from .functions.chunking import chunk_rows

    return chunk_rows(A.table(spark, d, "documents").select(F.concat(F.lit("doc:"), "doc_id").alias("url"), F.col("text").alias("markdown"))).select("url").distinct()


@query(f"select {_KEY} as k, count(*) as n from pages group by 1")
def object_keys(spark, d):
    from .functions.scalars import netloc, object_key

    p = A.raw_pages(spark, d)
    key = F.regexp_replace(F.substring_index(object_key("url", "md"), ".md", 1), "^[^/]*/", "")
    return p.where(netloc("url") != "").groupBy(key.alias("k")).agg(F.count("*").alias("n"))


# --- a fixed set of pages, with results written out ----------------------------------------------------------

FIXED = [
    ("https://a.org/dir/one", "fast", '<html lang="en"><head><title> One </title></head><body><nav><a href="/n">n</a></nav><article><h1>Head</h1><p>First <b>bold</b> and <a href="/x?a=1&amp;utm_source=q">link</a>.</p><ul><li>one<li>two</ul><p>Enough words follow here so that the article counts as the main content of the page, as over a hundred do.</p><img src="i.png"></article></body></html>'),
    ("https://b.org/", "rich", '<html><head><title>Two</title></head><body><p>Short <i>text</i></p><a href="#top">up</a><a href="mailto:x@y.z">mail</a><a href="HTTP://C.org">c</a><footer>f</footer></body></html>'),
    ("https://c.org/", "fast", ""),
]


def _fixed(spark):
    from .functions.html import process

    return process(spark.createDataFrame(FIXED, "url string, route string, html string"))


@query("""select * from (values
 ('https://a.org/dir/one', true, 'One', '# Head' || chr(10) || chr(10) || 'First **bold** and [link](/x?a=1&utm_source=q).' || chr(10) || chr(10) || '* one' || chr(10) || '* two' || chr(10) || chr(10) || 'Enough words follow here so that the article counts as the main content of the page, as over a hundred do.' || chr(10) || chr(10) || '![](i.png)', 'https://a.org/x?a=1&utm_source=q', 'https://a.org/dir/i.png', 'H1: Head'),
 ('https://b.org/', true, 'Two', 'Short _text_' || chr(10) || chr(10) || 'up[mail](mailto:x@y.z)[c](HTTP://C.org)', 'mailto:x@y.z|HTTP://C.org', '', ''),
 ('https://c.org/', false, null, null, null, null, null)) t(url, success, title, markdown, links, images, headings)""", fixed=True)
def fixed_extraction(spark, d):
    x = F.col("extracted")
    return _fixed(spark).select("url", "success", x["title"].alias("title"), x["markdown"].alias("markdown"), F.array_join(x["links"], "|").alias("links"), F.array_join(x["images"], "|").alias("images"), F.array_join(x["headings"], "|").alias("headings"))


@query("select * from (values ('https://a.org/dir/one', 1, 0, 'https://a.org/x?a=1'), ('https://b.org/', 1, 0, 'http://c.org/')) t(source_url, current_depth, position, url)", fixed=True)
def fixed_links(spark, d):
    """Links found in the fixed pages, as they go to the frontier."""
    from .streaming.pipeline import discovered

    return discovered(_fixed(spark))


@query("""select * from (values ('u', 0, 'intro' || chr(10) || chr(10) || 'Body of one, long enough to stand as a chunk by itself.', ''), ('u', 1, repeat('word ', 99) || 'word', 'One > Two'), ('u', 2, repeat('x', 500), 'Three'), ('u', 3, repeat('x', 100) || chr(10) || chr(10) || 'end', 'Three')) t(url, chunk_index, chunk_text, heading_ctx)""", fixed=True)
def fixed_chunks(spark, d):
    """A short beginning takes in what follows it, long text is cut, a short end folds back."""
    from .functions.chunking import chunk_rows

    text = "intro\n\n# One\n\nBody of one, long enough to stand as a chunk by itself.\n\n## Two\n" + "word " * 100 + "\n\n# Three\n" + "x" * 600 + "\n\n# Four\nend"
    return chunk_rows(spark.createDataFrame([("u", text), ("short", "tiny"), ("", text)], "url string, markdown string"))


#: A snippet for each rule, and the rules with their weights that it must hit, written out apart from the rules' own tables.
SNIPPETS = (
    ("<script id=__NEXT_DATA__>", "next_js -25"), ("window.__NUXT__=1", "nuxt_js -20"), ("<b ng-app>", "angular -40"), ('<div id="root"> </div>', "react_csr -35"), ("<i data-reactroot>", "react_ssr -10"), ("<i v-cloak>", "vue_js -30"),
    ('<i class="svelte-1x">', "svelte -20"), ('<script src="/a/chunk.0af1.js" defer>1', "webpack_bundle -20"), ('<script src="/a.js"> </script>', "heavy_js -5"), ('<img loading="lazy">', "lazy_loading -15"), ("load more", "infinite_scroll -10"),
    ("axios.get", "ajax_content -25"), ("<noscript>turn on a browser", "noscript_warning -20"), ('<i class="my-spinner">', "loading_ui -25"), ("<body> <div></div> </body>", "empty_body -40"), ("history.push", "spa_router -15"), ('<template id="x">', "web_components -15"),
    ("<article>", "article_tag 20"), ('<i id="main">', "main_content 15"), ("<h1>a</h1>", "header_structure 10"), ("<p>" + "x" * 200 + "</p>", "long_paragraphs 15"), ("<p>a</p>\n<p>b</p>\n<p>c</p>", "multiple_paragraphs 10"), ("generator Hugo", "static_generator 25"),
    ('<meta name="description" content="' + "x" * 50 + '">', "ssr_content 10"), ("<table>\n<tr></tr></table>", "table_data 10"), ("<ul>\n<li>a</li><li>b</li><li>c</li></ul>", "list_content 10"), ("wp-includes", "wordpress 15"), ("generator: Drupal", "cms_meta 15"),
    ("<p>plain text", ""), ("<ARTICLE>NG-APP", "angular -40,article_tag 20"),
)


@query("select * from (values " + ", ".join(f"({i}::bigint, '{hits}', {100 - 35 + sum(int(h.split()[1]) for h in hits.split(',') if h)})" for i, (_, hits) in enumerate(SNIPPETS)) + ") t(id, hits, raw_score)", fixed=True)
def fixed_rules(spark, d):
    """Each rule by a snippet of its own: what it hits, and the score of so short a page."""
    from .functions import scoring

    pages = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(SNIPPETS)], "id long, html string")
    names = F.array(*[F.lit(f"{n} {x}") for n, x, _ in scoring.rules()])
    hits = F.filter(F.arrays_zip(scoring.signals("html")["hits"].alias("hit"), names.alias("name")), lambda x: x["hit"])
    return scoring.analyse(pages.withColumn("hits", F.array_join(F.transform(hits, lambda x: x["name"]), ","))).select("id", "hits", F.col("raw_score").cast("int"))


# --- sessions, buffers, expansion, messages ----------------------------------------------------------------------

_SESSIONS = f"{CR}, h as (select 's' || id % 11 as session_id, crawl_time as timestamp, id from cr), n as (select max(timestamp) - interval '40 hours' as now from h)"


def _history(spark, d):
    h = A.crawl_results(spark, d).select(F.concat(F.lit("s"), F.col("id") % 11).alias("session_id"), F.col("crawl_time").cast("timestamp").alias("timestamp"), "id")
    return h, h.agg(F.max("timestamp").alias("t")).first().t


@query(f"with {_SESSIONS} select session_id, max(id) as id from (select session_id, first_value(id) over (partition by session_id order by timestamp desc) as id from h where timestamp > (select now from n) - interval '8 hours') group by session_id")
def session_progress(spark, d):
    """The last record of each session that is not older than two days."""
    from .operators import progress

    h, last = _history(spark, d)
    return progress.latest_progress(progress.alive(h, F.lit(last).cast("timestamp"))).select("session_id", "id")


@query(f"with {_SESSIONS} select session_id, count(*) as n, min(id) as first from (select *, row_number() over (partition by session_id order by timestamp desc, id desc) as r from h) where r <= 100 group by session_id")
def session_history(spark, d):
    from .operators import progress

    h, _ = _history(spark, d)
    order = h.withColumn("at", F.struct("timestamp", "id"))
    return progress.trimmed_history(order, time="at").groupBy("session_id").agg(F.count("*").alias("n"), F.min("id").alias("first"))


@query(f"with {_SESSIONS}, b as (select session_id, timestamp - to_hours((substr(session_id, 2)::int * 24)) as start_time, id from h), z as (select max(start_time) as t from b), o as (select session_id from b group by session_id having min(start_time) < (select t from z) - interval '35 days') select id from b where session_id not in (select session_id from o)")
def session_cleanup(spark, d):
    """Rows of sessions that began within thirty-five days of the last start."""
    from .operators import progress

    h, _ = _history(spark, d)
    b = h.withColumn("start_time", (F.col("timestamp") - F.make_dt_interval(hours=F.substring("session_id", 2, 9).cast("int") * 24)))
    last = b.agg(F.max("start_time").alias("t")).first().t
    return progress.without_old_sessions(b, F.lit(last).cast("timestamp"), 35).select("id")


@query("select 'w' || event_id % 4 as writer, event_id // 4 // 25 as flush, count(*) as n from events group by all")
def buffer_flushes(spark, d):
    """Writers' buffers of 25 rows, or five seconds, of rows that come 0.1 seconds apart."""
    from .operators import progress

    e = A.table(spark, d, "events").select(F.concat(F.lit("w"), F.col("event_id") % 4).alias("writer"), (F.col("event_id") / 40).alias("at"))
    return progress.flushes(e, "writer", "at", 25, 5.0).groupBy("writer", "flush").agg(F.count("*").alias("n"))


@query("""with recursive l as (select event_id as s, (event_id * 3 + k) % (select count(*) from events) as t from events, (values (1), (2)) v(k)), r(u, depth) as (select event_id, 0 from events where event_id < 5 union select l.t, r.depth + 1 from r join l on l.s = r.u where r.depth < 4)
 select 'u' || u as url, min(depth)::int as depth from r group by u""")
def expanded_links(spark, d):
    """Links followed from five seeds to a depth of four, each URL once."""
    from .operators import progress

    e = A.table(spark, d, "events")
    n, out = e.count(), _folder(spark, "depth")
    url = lambda c: F.concat(F.lit("u"), c)
    links = e.select("event_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("k")).select(url("event_id").alias("source_url"), url((F.col("event_id") * 3 + F.col("k")) % n).alias("url"))

    def put(level, depth):
        level.write.parquet(f"{out}/{depth}")
        return spark.read.parquet(f"{out}/{depth}")

    return progress.expand(e.where("event_id < 5").select(url("event_id").alias("url")), links, 4, put)


@query(f"""with {CR} select 'throughput' as metric_type, '{{"shard_id":' || shard_id || ',"n":' || count(*) || '}}' as data from cr group by shard_id""")
def metrics_messages(spark, d):
    from .operators import progress

    n = A.crawl_results(spark, d).groupBy("shard_id").agg(F.count("*").alias("n"))
    return progress.metric_events(n, "throughput", F.lit(0.0)).select("metric_type", "data")


@query("select count(*) filter (where length(html) < 5000) as success, count(*) filter (where length(html) >= 5000) as failed from pages")
def sent_messages(spark, d):
    from .operators import progress

    return progress.send_outcome(A.raw_pages(spark, d), F.length("html") < 5000)


@query("select event_id as id, event_id % 7 as k from events")
def decoded_records(spark, d):
    """Records written as JSON and read again."""
    e = A.table(spark, d, "events").select(F.to_json(F.struct(F.col("event_id").alias("id"), (F.col("event_id") % 7).alias("k"))).alias("raw_data"))
    return readers.decoded(e, "id long, k long")
