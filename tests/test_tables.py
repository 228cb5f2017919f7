"""Frontier, upserts, search, metrics, sources and streams on small tables."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from pagemill import api, schemas
from pagemill.functions import scalars
from pagemill.operators import frontier, merge, search
from pagemill.plans import metrics, reports
from pagemill.sources import readers
from pagemill.streaming import pipeline

T = datetime.datetime


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def none(spark):
    return spark.createDataFrame([], "url_hash string")


def test_discovered_dedup_and_cap(spark):
    u = spark.createDataFrame([("https://a/1", 1), ("https://a/1", 2), ("https://a/2", 3), ("https://a/3", 4), ("https://b/1", 5), ("https://b/2", 6)], "url string, arrival long").withColumn("source_url", F.lit("s"))
    done = spark.createDataFrame([("https://b/1",)], "url string").select(scalars.url_hash("url").alias("url_hash"))
    wait = spark.createDataFrame([("https://b/1",), ("https://b/2",)], "url string").select(scalars.url_hash("url").alias("url_hash"))
    counts = spark.createDataFrame([("a", 1)], "domain string, n long")
    out = frontier.add_discovered(u, done, wait, 3, counts, most=3)
    assert rows(out, "arrival", "outcome") == [(1, "added"), (2, "dedup_pending"), (3, "added"), (4, "domain_limit"), (5, "dedup_completed"), (6, "dedup_pending")]
    assert {r.queue for r in out.where("outcome = 'added'").collect()} == {"priority_low"}
    assert rows(frontier.outcome_counts(out)) == [("added", 2), ("dedup_completed", 1), ("dedup_pending", 2), ("domain_limit", 1)]


@pytest.mark.parametrize(("url", "depth", "want"), [("https://a.com/news/1", 1, "added"), ("https://a.com/newsletter", 3, "added"), ("https://a.com/x", 1, "scope_filtered"), ("https://b.com/news", 1, "scope_filtered"), ("https://a.com/news/1", 4, "scope_depth_limit")])
def test_scope(spark, url, depth, want):
    u = spark.createDataFrame([(url, 1, depth)], "url string, arrival long, current_depth int").withColumn("source_url", F.lit("s"))
    scope = F.struct(F.lit("").alias("seed_url"), F.lit("A.com").alias("allowed_domain"), F.lit("news").alias("path_prefix"), F.lit(3).alias("max_depth"), F.lit(10).alias("max_pages"))
    out = frontier.add_scoped(u.withColumn("scope", scope), none(spark), none(spark), 3).first()
    assert out.outcome == want and (out.queue == "priority_custom") == (want == "added")


def test_rebalance_moves_at_most_twenty(spark):
    q = [(0, "priority_low", i, f"l{i}") for i in range(40)] + [(0, "priority_normal", 700 + i, f"n{i}") for i in range(40)] + [(1, "priority_low", 1, "z")]
    df = spark.createDataFrame(q, "shard int, queue string, priority int, url string")
    out = frontier.rebalance(df, df.where("false"), 3)
    moved = out.where("moved").collect()
    assert out.count() == len(q) and len(moved) == 20 and {r.shard for r in moved} == {2}
    assert {r.url for r in moved} == {f"l{i}" for i in range(10)} | {f"n{i}" for i in range(10)}
    even = spark.createDataFrame([(s, "priority_low", 1, f"{s}{i}") for s in range(3) for i in range(5)], "shard int, queue string, priority int, url string")
    assert not frontier.rebalance(even, even.where("false"), 3).where("moved").count()


def test_batch_order(spark):
    q = spark.createDataFrame([(0, "priority_low", 1, "a"), (0, "priority_high", 900, "b"), (0, "priority_custom", 850, "c"), (0, "priority_high", 1000, "d")] + [(1, "priority_normal", i, f"m{i:02d}") for i in range(30)], "shard int, queue string, priority int, url string")
    got = [r.url for r in frontier.next_batch(q, 50, seed=1).orderBy("position").collect()]
    a, b = ["d", "b", "c", "a"], [f"m{i:02d}" for i in range(29, 9, -1)]
    assert got in (a + b, b + a)
    assert len(frontier.next_batch(q, 3).collect()) == 3


def test_states(spark):
    s = spark.createDataFrame([("a", "processing", 0, None, 0.0), ("b", "processing", 2, None, 0.0), ("c", "processing", 3, None, 0.0), ("d", "failed", 1, None, 0.0), ("e", "processing", 0, None, 0.0)], "url_hash string, state string, attempts int, due double, changed double")
    r = spark.createDataFrame([("a", True, False), ("b", False, True), ("c", False, True), ("e", False, False)], "url_hash string, success boolean, recoverable boolean")
    out = frontier.mark_completed(s, r, 100.0)
    assert [(x.url_hash, x.state, x.due) for x in out.orderBy("url_hash").collect()] == [("a", "completed", None), ("b", "failed", 1900.0), ("c", "failed", None), ("d", "failed", None), ("e", "failed", None)]
    assert frontier.cleanup(out, 90_000.0).count() == 1 and frontier.backpressure(5_000_000) and not frontier.backpressure(1)
    d = spark.createDataFrame([("x",), ("y",)], "domain string")
    assert rows(frontier.domain_delays(d, spark.createDataFrame([("x", 3.0)], "domain string, delay double")), "domain", "delay") == [("x", 3.0), ("y", 1.0)]


def test_seeds_and_ranks(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text("# c\n\nExample.com/news?x=1\nhttps://b.org\nexample.com/news\n")
    (tmp_path / "top-2026-01-01.csv").write_text("1,a.com\n2,b.com\nbad\n2000,c.com\n")
    seeds = readers.seed_list(spark, str(tmp_path / "seeds.txt"))
    assert rows(seeds) == [("https://b.org/",), ("https://example.com/news",)]
    q = frontier.add_seeds(seeds, seeds.where("url like '%b.org%'").select(scalars.url_hash("url").alias("url_hash")), 3)
    assert [(r.priority, r.scope.path_prefix) for r in q.collect()] == [(850, "/news")]
    ranks = readers.rank_list_of_day(spark, str(tmp_path / "top-{day}.csv"), datetime.date(2026, 1, 2))
    assert rows(frontier.prepare(ranks, 3), "domain", "priority", "queue") == [("a.com", 1000, "priority_high"), ("b.com", 1000, "priority_high"), ("c.com", 800, "priority_medium")]
    assert frontier.rank_lines(frontier.prepare(ranks, 3)).first().value == "1000,1,a.com,https://a.com/,root"
    with pytest.raises(FileNotFoundError):
        readers.rank_list_of_day(spark, str(tmp_path / "none-{day}.csv"), datetime.date(2026, 1, 2))


def test_upserts(spark):
    t = spark.createDataFrame([("a", "d", "old", 1), ("b", "d", "old", 5)], "url string, domain string, title string, version int")
    new = spark.createDataFrame([("a", "x", "n1", 1), ("a", "x", "n2", 2), ("c", "y", None, 1)], "url string, domain string, title string, processed_at long")
    once = merge.upsert_pages(t, new)
    assert sorted(tuple(r) for r in once.na.fill("-").collect()) == [("a", "d", "n2", 3), ("b", "d", "old", 5), ("c", "y", "-", 1)]
    stats = spark.createDataFrame([(T(2024, 1, 1), 9, 4, 4, 0)], "stat_hour timestamp, total_crawled long, total_processed long, fast_processed long, rich_processed long")
    assert merge.upsert_hourly(stats, stats).first().asDict() | {"stat_hour": 0} == {"stat_hour": 0, "total_crawled": 9, "total_processed": 8, "fast_processed": 8, "rich_processed": 0}
    good, bad = merge.split_valid(new.withColumn("crawled_at", F.when(F.col("url") == "a", 1)))
    letters = merge.dead_letters(bad, F.lit("DataError"), F.concat(F.lit("x\0"), F.repeat(F.lit("y"), 2000)), F.lit(1)).first()
    assert good.count() == 2 and len(letters.error_message) == 999 and json.loads(letters.raw_data)["url"] == "c"


def test_search(spark):
    c = spark.createDataFrame([("u1", 0, "one", "H", [1.0, 0.0]), ("u2", 0, "two", None, [0.6, 0.8]), ("u3", 0, "zero", None, [0.0, 0.0]), ("gone", 1, "three", None, [0.9, 0.1]), ("u4", 0, "none", None, None)], "url string, chunk_index int, chunk_text string, heading_ctx string, embedding array<float>").withColumn("created_at", F.lit(T(2024, 1, 1)))
    p = spark.createDataFrame([(f"u{i}", f"T{i}", "d" if i != 2 else "e", "en", T(2024, 1, 1)) for i in range(1, 5)], "url string, title string, domain string, language string, crawled_at timestamp")
    assert [(r.url, r.similarity) for r in search.search(c, p, [1.0, 0.0], 5, 0.3).orderBy(F.desc("similarity")).collect()] == [("u1", 1.0), ("gone", 0.9939), ("u2", 0.6)]
    assert [r.url for r in search.search(c, p, [1.0, 0.0], 5, 0.0, "e").collect()] == ["u2"]
    text = search.format_context(search.search(c, p, [1.0, 0.0], 2)).first().context
    assert text.startswith("[1] T1 (d)\nURL: u1\n위치: H (유사도: 1.00)\n\none\n\n---\n\n[2] 제목 없음 ()")
    assert search.format_context(search.search(c, p, [1.0, 0.0], 2).where("false")).first().context == "관련 문서를 찾을 수 없습니다."
    big = spark.createDataFrame([("u", "t", "d", "x" * 300, None, i, 1.0 - i / 100) for i in range(5)], "url string, title string, domain string, chunk_text string, heading_ctx string, chunk_index int, similarity double")
    found = search.context_sections(big, 600).orderBy("rank").collect()
    assert len(found) == 2 and found[1].section.endswith("...")
    with pytest.raises(ValueError):
        search.search(c, p, [1.0, 0.0], 51)
    with pytest.raises(ValueError):
        search.check_dimension(c, 3)
    search.check_dimension(c, None)
    with pytest.raises(api.NotFound):
        api.chunks(c, p, "nowhere")
    assert api.chunks(c, p, "u1")[0]["title"] == "T1" and api.stats(c)["total_urls"] == 4 and api.health(spark)["status"] == "ok"
    assert api.find(c.limit(0), p, "hello").count() == 0


def test_errors_and_scalars(spark):
    cases = [("Timeout!", None, "timeout"), ("x", 403, "http_403_forbidden"), ("timeout", 404, "http_404_not_found"), ("", 429, "http_429_rate_limit"), (None, 599, "http_5xx_server_error"), ("bad Certificate", 200, "ssl_error"), ("conn RESET", None, "connection_error"), ("getaddrinfo", None, "dns_error"), ("robots 불허", None, "robots_blocked"), ("charset", None, "content_error"), (None, None, "unknown")]
    df = spark.createDataFrame([(m, s) for m, s, _ in cases], "m string, s int")
    assert [r.k for r in df.select(scalars.crawl_error("m", "s").alias("k")).collect()] == [k for *_, k in cases]
    fetch = [("timeout", "", "timeout"), ("connect", "SSL: x", "ssl_error"), ("connect", "DNS", "dns_error"), ("connect", "x", "connection_error"), ("too_many_redirects", "", "too_many_redirects"), ("read", "", "read_error"), ("?", None, "unknown")]
    df = spark.createDataFrame([(a, b) for a, b, _ in fetch], "a string, b string")
    assert [r.k for r in df.select(scalars.fetch_error("a", "b").alias("k")).collect()] == [k for *_, k in fetch]
    r = spark.range(1).select(scalars.strip_nul(F.lit("a\0b")).alias("a"), scalars.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("c"), scalars.word_count(F.lit("  a \n b ")).alias("w")).first()
    assert (r.a, r.c, r.w) == ("ab", None, 2)


def test_quantiles_and_counters(spark):
    h = spark.createDataFrame([(v,) for v in (0.05, 0.3, 0.3, 0.7, 1.5, 99.0)], "response_time double")
    b = metrics.histogram(h, [])
    assert rows(b.where("le < 100"), "le", "n")[:4] == [(0.1, 1), (0.5, 3), (1.0, 4), (2.0, 5)]
    assert metrics.histogram_quantile(b, 0.5, []).first().quantile == 0.5 and metrics.histogram_quantile(b, 0.99, []).first().quantile == 60.0
    s = spark.createDataFrame([(T(2024, 1, 1, 0, i), "c", v) for i, v in enumerate((1.0, 5.0, 2.0))], "ts timestamp, name string, value double")
    assert [r.increase for r in metrics.increases(s, []).orderBy("ts").collect()] == [4.0, 2.0]
    assert metrics.instant(s, []).first().value == 2.0
    assert api.validate_metrics(metrics.range_summary(s), ["c", "d"]) == ["d"]


def test_quantiles_in_two_passes(spark):
    """Interpolated quantiles of groups with many equal values, few values and none, and their totals."""
    import numpy as np

    rng = np.random.default_rng(4)
    groups = {"many": rng.lognormal(size=500).round(2).tolist() + [1.25] * 300, "one": [3.5], "two": [-2.0, 7.0], "none": []}
    data = [(k, v) for k, vs in groups.items() for v in vs + [None]]
    got = reports.quantiles(spark.createDataFrame(data, "k string, v double"), "k", "v", {"a": 0.5, "b": 0.95, "c": 1.0}, {"n": F.lit(1), "s": F.col("v")}).collect()
    assert {r.k for r in got} == set(groups)
    for r in got:
        vs = groups[r.k]
        assert r.n == len(vs) + 1
        if vs:
            assert np.allclose([r.a, r.b, r.c, r.s], [*np.quantile(vs, [0.5, 0.95, 1.0]), sum(vs)])
        else:
            assert (r.a, r.b, r.c, r.s) == (None, None, None, None)


def test_sliding_rates(spark):
    """Windows with resets, gaps, single samples and rises from zero, against a plain reading of each window."""
    import numpy as np

    rng = np.random.default_rng(6)
    series = {}
    for name in "abc":
        t = np.cumsum(rng.choice([0.5, 7, 15, 15, 15, 60, 400], 300)) + 1_700_000_000
        v = np.cumsum(rng.choice([0, 1, 5], 300)).astype(float)
        for at in (90, 91, 200):
            v[at:] -= v[at]
        series[name] = list(zip(t.tolist(), v.tolist(), strict=True))
    series["edge"] = [(1_700_000_040.0, 0.0), (1_700_000_100.0, 6.0), (1_700_000_340.0, 9.0)]
    data = [(n, T.fromtimestamp(t, datetime.timezone.utc).replace(tzinfo=None), v) for n, s in series.items() for t, v in s] + [("a", None, 1.0), ("b", T(2024, 1, 1), None)]
    got = {(r.name, int(r.ts.replace(tzinfo=datetime.timezone.utc).timestamp())): r.rate for r in metrics.sliding_rate(spark.createDataFrame(data, "name string, ts timestamp, value double"), []).collect()}
    want = {}
    for name, s in series.items():
        for end in range(int(s[0][0]) // 60 * 60, int(s[-1][0]) + 361, 60):
            w = [(t, v) for t, v in s if end - 300 < t <= end]
            if len(w) < 2:
                continue
            rise = sum(b if b < a else b - a for (_, a), (_, b) in zip(w, w[1:], strict=False))
            span = w[-1][0] - w[0][0]
            gap = span / (len(w) - 1)
            start, stop = (x if x < 1.1 * gap else gap / 2 for x in (w[0][0] - (end - 300), end - w[-1][0]))
            if rise > 0:
                start = min(start, span * w[0][1] / rise)
            want[name, end] = rise * (span + start + stop) / span / 300
    assert got.keys() == want.keys() and len(want) > 500
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert metrics.sliding_rate(spark.createDataFrame([], "name string, ts timestamp, value double"), []).count() == 0


def test_sketches(spark):
    """Estimates of windows from merged sketches of hours are within the stated error; nulls count as rows alone."""
    rows = spark.range(60000).select((F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=(F.col("id") % 2880).cast("int"))).alias("created_at"), F.when(F.col("id") % 10 != 0, F.concat(F.lit("d"), (F.col("id") * 7919) % 20011)).alias("domain"))
    parts = [reports.hourly_sketches(rows.where(F.pmod(F.hash("domain"), F.lit(3)) == k)) for k in range(3)]
    for r in reports.estimated_totals(reports.merged_sketches(*parts), "1 day", "12 hours").collect():
        inside = rows.where((F.col("created_at") >= F.lit(r.start)) & (F.col("created_at") < F.lit(r.start) + F.expr("interval 1 day")))
        n, exact = inside.agg(F.count("*"), F.count_distinct("domain")).first()
        assert r.estimated_total == n and abs(r.estimated_distinct - exact) <= exact * reports.SKETCH_ERROR


def test_readers(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"tests": [{"name": "a", "status": "passed", "duration": 1.0}, {"name": "b", "status": "failed", "duration": 3.0}]}))
    tests = readers.test_report(spark, str(tmp_path / "r.json"))
    assert readers.test_summary(tests).first().asDict() == {"total": 2, "passed": 1, "failed": 1, "skipped": 0, "pass_rate": 50.0, "seconds": 4.0}
    assert readers.slowest_tests(tests, 1).first().name == "b"
    (tmp_path / "p.html").write_text("<p>x</p>\n<p>y</p>")
    assert readers.html_files(spark, str(tmp_path / "p.html")).first().html == "<p>x</p>\n<p>y</p>"
    m = spark.createDataFrame([("a", None, "<p>"), ("b", None, ""), ("c", b"plain \xff", None)], "url string, html_compressed binary, html string")
    assert rows(readers.raw_html(m), "url", "html") == [("a", "<p>"), ("c", "plain �")]
    objects = spark.createDataFrame([("k", "https://ü/x", "text")], "key string, url string, content string")
    readers.store_objects(objects, str(tmp_path / "o"))
    stored = spark.read.parquet(str(tmp_path / "o"))
    assert stored.first().url == "https:///x"
    p = spark.createDataFrame([("u", "k"), ("v", "none")], "url string, markdown_key string")
    assert readers.page_with_content(p, stored, "u").first().markdown == "text" and readers.page_with_content(p, stored, "v").first().markdown is None
    assert readers.objects_exist(p.select(F.col("markdown_key").alias("key")), stored).count() == 1
    assert schemas.PAGES["url"].dataType.simpleString() == "string"


def test_streams(spark, tmp_path, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    pages.limit(20).repartition(2).write.parquet(src)
    seen = []
    raw = pipeline.messages(spark, src, pages.schema, "router", 1)
    pipeline.start_router(raw, out, str(tmp_path / "c1"), on_batch=lambda b, i: seen.append(i)).awaitTermination()
    assert seen == [0, 1]
    routed = spark.read.parquet(f"{out}/process.fast").drop("batch")
    again = pipeline.messages(spark, f"{out}/process.fast/batch=0", routed.schema)
    pipeline.start_processor(again, out, str(tmp_path / "c2")).awaitTermination()
    first = spark.read.parquet(f"{out}/process.fast/batch=0").count()
    assert spark.read.parquet(f"{out}/processed.final").count() == first
    schema = spark.createDataFrame([], "url string, domain string, title string, version int").schema
    table = pipeline.MergedTable(spark, f"{out}/table", schema, ["url"], 4)
    batches = pipeline.messages(spark, src, pages.schema, files_per_trigger=1).selectExpr("url", "'d' as domain", "'t' as title", "page_id as processed_at")
    pipeline.start_upsert(batches, table, merge.upsert_pages, str(tmp_path / "c3")).awaitTermination()
    assert table.read().count() == 20
    # A batch that runs again ends in the same table; a later one goes on from it.
    again = pages.limit(5).selectExpr("url", "'e' as domain", "'new' as title", "page_id as processed_at")
    for _ in range(2):
        table.apply(again, 2, merge.upsert_pages)
        assert sorted(r.version for r in table.read().collect()) == [1] * 15 + [2] * 5
    pipeline.start_upsert(batches, table, merge.upsert_pages, str(tmp_path / "c4"), may_run=lambda: False).awaitTermination()
    assert {r.domain for r in table.read().collect()} == {"d"} and table.read().where("title = 'new'").count() == 5
    links = spark.createDataFrame([("s", True, 1, {"links": ["https://A/?ref=1", "https://a/", "x"]})], "url string, success boolean, current_depth int, extracted struct<links:array<string>>")
    assert rows(pipeline.discovered(links)) == [("s", 2, 0, "https://a/")]


def test_report_sections(spark, small):
    from pagemill.sources import adapters

    r = adapters.crawl_results(spark, small)
    out = api.failure_report(r, adapters.AS_OF, 24 * 31, "d7.example.com")
    assert set(out) == {"overall", "errors", "domains", "times", "domain", "domain_errors"} and out["overall"].first().total_requests > 0
    assert reports.dlq_stats_if_exists(spark, "nothing_here", adapters.AS_OF).first().dlq_total == 0


def test_batches_of_rows(spark):
    from pagemill.operators import progress

    got = list(progress.in_batches(spark.range(25, numPartitions=3), 10))
    assert [len(b) for b in got] == [10, 10, 5] and sorted(r.id for b in got for r in b) == list(range(25))


def test_remote_embedder(spark):
    from pagemill.functions import chunking

    asked = []

    def post(url, body, headers):
        asked.append((url, len(body["input"]), headers["Authorization"]))
        return {"data": [{"embedding": [float(len(t)), 1.0]} for t in body["input"]]}

    e = chunking.create_embedder("remote", url="https://e", model="m", key="k", dimension=2, batch=2, post=post)
    assert e.embed_batch(["a", "bb", "ccc"]).tolist() == [[1, 1], [2, 1], [3, 1]] and asked == [("https://e", 2, "Bearer k"), ("https://e", 1, "Bearer k")]
    assert e.embed_batch([]).shape == (0, 2)
    with pytest.raises(ValueError, match="shape"):
        chunking.create_embedder("remote", url="u", model="m", dimension=3, post=post).embed_batch(["a"])


def test_flushes_by_age(spark):
    from pagemill.operators import progress

    rows = spark.createDataFrame([("a", t) for t in (0.0, 1.0, 4.9, 5.0, 5.1, 30.0)] + [("b", 0.0)], "w string, t double")
    got = sorted((r.w, r.t, r.flush) for r in progress.flushes(rows, "w", "t", 3, 5.0).collect())
    assert [f for _, _, f in got] == [0, 0, 0, 1, 1, 2, 0]


def test_recall_of_the_inverted_file(spark):
    """The five nearest chunks by three of eight lists, for every twentieth vector, against all chunks."""
    import numpy as np

    from pagemill.operators import search

    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    centres = search.learn_centres(rows, 8)
    lists = {r.id: r.list_id for r in search.assign_lists(rows, centres).select("id", "list_id").collect()}
    vectors = {r.id: np.array(r.embedding, float) for r in rows.collect()}
    ids = sorted(vectors)
    unit = np.array([vectors[i] / np.linalg.norm(vectors[i]) for i in ids])
    c = np.array(centres)
    found = total = 0
    for k in range(0, len(ids), 20):
        probed = set(np.argsort(-(c @ unit[k]) / np.linalg.norm(c, axis=1), kind="stable")[:3].tolist())
        best = np.argsort(-(unit @ unit[k]), kind="stable")[:5]
        found += sum(lists[ids[j]] in probed for j in best)
        total += 5
    assert found >= 0.6 * total, found / total
    print("recall", found / total)
