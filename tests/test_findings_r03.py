"""What the findings of round 3 named, each by a case that failed before."""

import datetime
import itertools
import re
import time
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from pagemill import page_queries, queries, store_queries
from pagemill.functions import arrow, chunking, html
from pagemill.llm import common, restaurants, simhash
from pagemill.operators import merge, trigrams
from pagemill.operators.frontier import QUEUE_ORDER
from pagemill.streaming import states


def test_blanks_at_a_cut_stay_where_chunks_join():
    """a cut that begins with a blank and takes in what follows keeps it."""
    out = chunking.chunks("a" * 500 + " bbb.\n\nccc")
    assert [c["text"] for c in out] == ["a" * 500 + "\n\n bbb.\n\nccc"]


def test_references_without_their_end_stay():
    """What is left of a reference that was cut is text, in content and in attributes."""
    page = '<html><head><title>a &amp; b &lt;c&gt; &#39;d&#x27; &amp</title></head><body><p>x&ampy; &notit; &copy; 1&2 <a href="/s?a=1&copy=2&amp;b=3">y</a></p></body></html>'
    assert html.page_metadata(html.parse(page))["title"] == "a & b <c> 'd' &amp"
    rich, old = html.extract_rich("https://x.org/", page), html.legacy_text(page, "https://x.org/")
    assert rich["title"] == old["title"] == "a & b <c> 'd' &amp" and rich["content_length"] == len(page)
    assert rich["plain_text"] == "x&ampy; &notit; © 1&2 y" and rich["links"] == ["https://x.org/s?a=1&copy=2&b=3"]


@pytest.fixture(scope="module")
def twins(spark, tmp_path_factory):
    """Pages of which each URL stands twice, as a folder of tables."""
    d = f"file://{tmp_path_factory.mktemp('twins')}"
    spark.range(12).select(F.col("id").alias("page_id"), F.concat(F.lit("https://x.org/"), F.col("id") % 5).alias("url"), F.concat(F.lit("<html><body>"), F.repeat(F.lit("a "), (F.col("id") + 1).cast("int")), F.lit("</body></html>")).alias("html")).write.parquet(f"{d}/pages.parquet")
    return d


def test_objects_of_pages_that_share_a_key(spark, twins):
    """a page is there by its own text, not by that of another page with its URL."""
    assert sorted(r.id for r in store_queries.existing_objects(spark, twins).collect()) == [i for i in range(12) if i % 3 != 1]


def test_messages_of_pages_that_share_a_url(spark, twins):
    """one message a page."""
    assert sorted(r.page_id for r in queries.raw_page_messages(spark, twins).collect()) == [i for i in range(12) if i % 5]


@pytest.mark.parametrize("turn", [1, -1])
def test_arrivals_at_one_time(spark, turn):
    """F16: of several that arrive at once the one crawled first counts, in whatever order they stand."""
    ddl = "url string, domain string, static_score int, crawled_at timestamp"
    stored = spark.createDataFrame([], f"{ddl}, version int")
    at = spark.sql("select timestamp '2024-01-01' as t").first().t
    rows = [("u", f"d{k}", k, at.replace(minute=k), 7) for k in (2, 1, 3)][::turn] + [("u", "late", 9, at.replace(hour=5), None)]
    new = merge.upsert_pages(stored, spark.createDataFrame(rows, f"{ddl}, processed_at int").coalesce(1)).collect()
    assert [tuple(r) for r in new] == [("u", "d1", 1, at.replace(minute=1), 4)]


def test_claims_read_a_queue_once(spark, tmp_path):
    """F2: a micro-batch reads its queue once however many claims it holds; places that change between them count."""

    class Map(dict):
        reads = 0

        def iterator(self):
            self.reads += 1
            return iter(list(self.items()))

        containsKey, getValue, updateValue, removeKey = dict.__contains__, dict.get, dict.__setitem__, dict.pop

    def row(kind, url=None, queue="normal", priority=None, batch=None, size=None):
        return Row(kind=kind, url=url, queue=queue, priority=priority, batch=batch, size=size, arrival=next(count))

    count, low, high = itertools.count(), QUEUE_ORDER[-1], QUEUE_ORDER[0]
    c = states.Claiming()
    c.queued, c.taken, c.done = Map(), Map(), Map()
    rows = [row("add", f"u{i:03}", low, i) for i in range(100)] + [row("claim", batch=b, size=3) for b in range(5)]
    rows += [row("add", "u000", high, 1), row("add", "u001", low, 500), row("back", "u099", low, 2), row("done", "u098"), row("add", "u098", high, 9)]
    rows += [row("claim", batch=b, size=3) for b in range(5, 90)]
    got = [(r.batch, r.position, r.url) for r in c.handleInputRows((0,), iter(rows), None)]
    left = ["u000", "u001", *(f"u{i:03}" for i in range(84, 2, -1)), "u002", "u099"]
    want = [f"u{i:03}" for i in range(99, 84, -1)] + left
    assert got == [(i // 3, i % 3 + 1, u) for i, u in enumerate(want)] and c.queued.reads == 1


def test_few_rows_leave_where_queries_meet_codes(spark, tmp_path, monkeypatch):
    """with many slabs, salts and parts a search is exact, and far fewer rows than all pairs go on from there."""
    from pagemill.operators import vector_index

    for name, value in (("SLAB", 40), ("QUERIES", 7)):
        monkeypatch.setattr(vector_index, name, value)
    v = np.random.default_rng(8).normal(size=(1200, 16))
    rows = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v.astype(np.float32))], "id long, embedding array<float>")
    index = vector_index.VectorIndex(spark, f"file://{tmp_path}/x")
    index.train(rows, lists=5)
    index.add(rows, "all")
    asked = rows.where("id % 12 = 0").select(F.col("id").alias("query_id"), "embedding")
    unit = v.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    got = {}
    for r in index.search(asked, k=4, probes=5).orderBy("query_id", F.desc("similarity"), "id").collect():
        got.setdefault(r.query_id, []).append(r.id)
    assert got == {q: np.argsort(-(unit @ unit[q]), kind="stable")[:4].tolist() for q in range(0, 1200, 12)}
    assert index.likely(index.nearest_lists(asked, 5, "query_id", "embedding"), 4).count() < 0.05 * 100 * 1200


def test_titles_that_share_most_grams(spark, tmp_path, monkeypatch):
    """pairs that only share frequent grams are no rows of a join; with many slabs and parts, and an id in two batches, the result is exact."""
    monkeypatch.setattr(trigrams, "SLAB", 500, raising=False)
    words = ["the", "ship", "of", "harbour", "sails", "north"]
    titles = [" ".join(words[(i * k) % 6] for k in range(1, 5)) + f" {i * 7919 % 1000}" for i in range(150)]
    rows = spark.createDataFrame(list(enumerate(titles)), "id long, title string")
    index = trigrams.TrigramIndex(spark, f"file://{tmp_path}/i", 8)
    index.add(rows, "all")
    index.add(rows.where("id = 3"), "more")
    found = index.search(rows.where("id % 5 = 0").selectExpr("cast(id as string) as query_id", "title as text"), 0.5)
    g = [{f"  {w} "[i : i + 3] for w in t.split() for i in range(len(w) + 1)} for t in titles]
    want = sorted((str(a), b, len(g[a] & g[b]) / len(g[a] | g[b])) for a in range(0, 150, 5) for b in [*range(150), 3] if len(g[a] & g[b]) / len(g[a] | g[b]) >= 0.5)
    assert sorted(tuple(r) for r in found.collect()) == want and len(want) > 200
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString().replace("LeftSemi", "")


class Counted(dict):
    """A map state that counts calls."""

    calls = 0

    def _call(self, f, *args):
        self.calls += 1
        return f(self, *args)

    def containsKey(self, k):
        return self._call(dict.__contains__, k)

    def getValue(self, k):
        return self._call(dict.get, k)

    def updateValue(self, k, v):
        self._call(dict.__setitem__, k, v)

    def removeKey(self, k):
        self._call(dict.pop, k)

    def keys(self):
        return self._call(lambda s: list(dict.keys(s)))


class Value:
    """A value state."""

    held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, v):
        self.held = v

    def clear(self):
        self.held = None


def test_discovery_asks_the_state_once_a_url():
    """repeats within a micro-batch cost no call; a reset between them forgets."""
    d = states.Discovery(1000, None)
    d.seen, d.added, d.seeds = Counted(), Value(), Counted()
    rows = [Row(kind="reset" if i == 500 else "url", url=f"u{i % 20}", seed="s" if i % 20 == 3 else None, depth=0, max_depth=3, max_pages=9, arrival=i) for i in range(1000)]
    got = [r.outcome for r in d.handleInputRows(("d",), iter(rows[::-1]), None)]
    assert got.count("added") == 40 and got.count("reset") == 1 and d.added.held == (19,) and len(d.seen) == 20 and dict(d.seeds) == {("s",): (1,)}
    assert d.seen.calls + d.seeds.calls < 100


def test_retries_read_what_waits_once():
    """successes without waiting timers cost no call each."""
    t, timers, w = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC), set(), states.Retrying(3, 30)
    w.handle, w.failures, w.waiting = type("H", (), {"registerTimer": staticmethod(timers.add), "deleteTimer": staticmethod(timers.discard)}), Value(), Counted()
    first = int(t.timestamp() * 1000) + 60_000
    w.waiting[(first,)], _ = (1,), timers.add(first)
    rows = [Row(success=i % 10 != 9, recoverable=True, at=t + datetime.timedelta(seconds=i)) for i in range(500)]
    assert list(w.handleInputRows(("u",), iter(rows), None)) == []
    due = int(t.timestamp() * 1000) + 499_000 + 1_800_000
    assert dict(w.waiting) == {(due,): (1,)} and timers == {due} and w.waiting.calls < 10


def test_pages_are_extracted_in_parts(spark):
    """however many rows a batch has, the results of few pages are held at a time, and every row gets its own."""
    seen = []
    run = arrow.in_parts(lambda a, b: seen.append(len(a)) or a + b, 3)
    got = list(run(iter([(pd.Series(range(7)), pd.Series(range(7))), (pd.Series([], dtype=int),) * 2])))
    assert seen == [3, 3, 1, 0] and [x for g in got for x in g] == [0, 2, 4, 6, 8, 10, 12]
    rows = spark.range(0, 2000, 1, 1).select("id", F.concat(F.lit("<title>t"), "id", F.lit("</title>")).alias("html"))
    assert rows.select("id", html.metadata("html")["title"].alias("t")).where("t <> concat('t', id)").count() == 0


def test_headings_of_titles_without_letters(spark, tmp_path):
    """a heading that ends in a blank stays as it is set, on both routes."""
    duckdb = pytest.importorskip("duckdb")
    titles = ["1984 2000", "Some words", "\u0394\u03bf \u4e2d", "", "9", "Page 3", "12", "x", "77", "\u00e9t\u00e9", "5 5", "--"]
    page = "<html><head><title>{}</title></head><body><p>First words of it</p></body></html>"
    rows = [(k, f"https://x{k}.org/a/{k}", page.format(t)) for k, t in enumerate(titles * 2)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    sql = duckdb.connect()
    sql.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    for name in ("marked_chunks", "marked_extraction", "marked_metadata", "marked_records"):
        answer = sql.execute(queries.ORACLE[name])
        want = [dict(zip([c[0] for c in answer.description], r, strict=True)) for r in answer.fetchall()]
        got = [r.asDict() for r in queries.QUERIES[name](spark, f"file://{tmp_path}").collect()]
        in_order = [sorted(rows, key=lambda r: [str(r[c]) for c in sorted(r)]) for rows in (got, want)]
        assert in_order[0] == in_order[1] and got, name
    assert page_queries.marked_pages(spark, f"file://{tmp_path}").count() == len(rows)


def seatings(c, d, a):
    """Mean and variance of the number of tables, by counting all seatings."""
    ways = np.array([1.0])
    for n in range(1, c):
        ways = np.append(ways * (n - d * np.arange(1, n + 1)), 0) + np.append(0, ways)
        ways /= ways.max()
    t = np.arange(1, c + 1)
    p = np.exp(np.log(np.maximum(ways, 1e-300)) + t * np.log(a) - np.max(np.log(np.maximum(ways, 1e-300)) + t * np.log(a)))
    p /= p.sum()
    return (p * t).sum(), (p * t * t).sum() - (p * t).sum() ** 2


@pytest.mark.parametrize("c,d,a", [(100, 0.8, 1.0), (200, 0.8, 20.0), (300, 0.3, 4.0), (250, 0.95, 0.1)])
@pytest.mark.parametrize("listed", [restaurants.LISTED, 1])
def test_all_customers_are_seated_anew(c, d, a, listed):
    """a round leaves nobody where an earlier one or a start put them, however many there are."""
    size = 3000 if listed > c else 600
    got = restaurants.seated(np.full(size, c), np.full(size, a), d, np.random.default_rng(1), listed)
    mean, variance = seatings(c, d, a)
    assert got.mean() == pytest.approx(mean, abs=5 * (variance / size) ** 0.5) and got.var() == pytest.approx(variance, rel=0.35)


def test_a_very_common_pair_is_seated_whole():
    """ten million customers are one draw; with few tables these are one more than a Poisson number, and the mean is known for many."""
    c, d = 10_000_000, 0.8
    few = restaurants.seated(np.full(300, c), np.full(300, 1.6), d, np.random.default_rng(2))
    assert few.mean() == pytest.approx(3, abs=0.5) and few.var() == pytest.approx(2, rel=0.4)
    many = restaurants.seated(np.full(20, c), np.full(20, 1e5), d, np.random.default_rng(2))
    assert many.mean() == pytest.approx(1e5 / d * (1 - (1e5 / c) ** 4), rel=0.01)


def test_no_table_of_simhash_goes_through_the_driver(spark, small):
    """no join of the fingerprints' links and components is a broadcast one."""
    runs = spark._jsparkSession.sharedState().statusStore()
    before = runs.executionsCount()
    simhash.near_duplicates(spark.read.parquet(f"{small}/documents.parquet")).write.format("noop").mode("overwrite").save()
    plans = runs.executionsList(before, 1000)
    told = [plans.apply(i).physicalPlanDescription() for i in range(plans.size())]
    assert any("SortMergeJoin" in x for x in told) and not [x for x in told if "BroadcastExchange" in x]


def test_fingerprints_propose_near_duplicates(spark, monkeypatch):
    """the pipeline's step links by SimHash fingerprints, decided by whole sets; MinHash keys only add to these."""
    import corpus_pipeline
    from pagemill.llm import shingles

    monkeypatch.setattr(shingles, "band_keys", lambda members: np.zeros(0, np.uint64))
    words = [f"w{i}" for i in range(400)]
    edited = [*words[:399], "other"]
    texts = [words, edited, words[::-1], ["short"], ["short"], ["brief"], words, words[:200] + words[:200][::-1]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    prints = [simhash.majority(shingles.shingle_set(" ".join(t).encode(), 5)) for t in texts[:2]]
    assert prints[0] != prints[1] and (prints[0] ^ prints[1]).bit_count() <= 2
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [0, 2, 3, 5, 7]


def test_stages_read_small_batches(spark):
    """Pipeline, memory of executors: a stage's batches hold a few MB, whatever the partition; a session's own limit stays."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("words "), 1000).alias("text"))
    try:
        for own, least, most in ((None, 3, 5 << 20), ("1m", 10, 2 << 20)):
            spark.conf.unset(common.BATCH_LIMIT)
            if own:
                spark.conf.set(common.BATCH_LIMIT, own)
            masked = corpus_pipeline.mask_secrets(spark, docs, "")
            found = [r.n for r in masked.mapInArrow(sizes, "n long").collect()]
            assert len(found) >= least and max(found) < most and sum(found) > 18_000_000
    finally:
        spark.conf.unset(common.BATCH_LIMIT)


def test_workers_return_freed_memory(spark):
    """Pipeline, memory of executors: what a task has freed does not stay with the Python worker."""

    class Frame:
        def mapInArrow(self, run, schema):
            return run

    def own():
        return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) // 1024

    pins = []

    def work(batch):
        arrays = [np.ones(60_000, np.uint8) for _ in range(4000)]
        pins.append(arrays[-1])  # the heap can't shrink from its end
        return batch

    run, before = common.arrow_map(Frame(), work, "n bigint"), own()
    assert len(list(run(iter([pa.RecordBatch.from_pydict({"n": [1]})])))) == 1
    assert own() - before < 60


def test_words_are_encoded_without_an_object_for_each():
    """F2, op11's CPU time: words of every length keep their hashes, and a block takes a fraction of the time of one call for each word."""
    rng = np.random.default_rng(3)
    words = [rng.bytes(n) for n in range(80) for _ in range(9)]
    size = np.array([len(w) for w in words])
    got = restaurants.hashes_of(np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size)
    assert got.tolist() == [xxhash.xxh64_intdigest(w) for w in words]
    text = b" ".join(b"%x" % n for n in rng.integers(1 << 40, size=600_000))
    start = time.process_time()
    [xxhash.xxh64_intdigest(w) for w in text.translate(common.LOWER).split()]
    each = time.process_time() - start
    block = restaurants.Block()
    start = time.process_time()
    block.add((1, True, False), text)
    block.encode(0)
    assert block.size == 600_001 and time.process_time() - start < 1.2 * each


@pytest.mark.parametrize("piece", [1, 30, 1 << 20])
def test_blocks_hold_the_words_of_odd_texts(piece, monkeypatch):
    """blanks alone, none, bytes that are no blanks here, very long words and cuts anywhere give the same tokens."""
    monkeypatch.setattr(restaurants, "PIECE", piece)
    rng = np.random.default_rng(4)
    texts = [b"", b" ", b"\n\n", b"A b\tA", b"x" * 70 + b" y", b"\x85\xa0 \x1c\x1d \x00 a\x00", "\u00c9 \u1e9e".encode(), b""]
    texts += [rng.choice(np.frombuffer(b"abC \n\t\v\f\r", np.uint8), n).tobytes() for n in range(0, 200, 7)]
    block = restaurants.Block()
    for i, text in enumerate(texts):
        block.add((i, True, False), text)
    keys, word, context, doc = block.arrays()
    told = [[xxhash.xxh64_intdigest(w) for w in re.findall(rb"[^\x20\x09-\x0D]+", t.translate(common.LOWER))] + [restaurants.END] for t in texts]
    assert [keys[word[doc == i]].tolist() for i in range(len(texts))] == told
    assert [keys[context[doc == i]].tolist() for i in range(len(texts))] == [[restaurants.START, *t[:-1]] for t in told]
    assert block.lengths.tolist() == [len(t) for t in told] and block.size == sum(map(len, told)) and len(block.rows) == len(texts)


def test_seatings_are_counted_once_for_all_rounds(monkeypatch):
    """ways to seat customers that a round has counted are not counted again, and larger numbers go on from there."""
    few, more = np.array([2, 700, 700, 40]), np.array([900, 40, 2, 5])
    opening, rng = np.full(4, 3.0), np.random.default_rng
    first, second = restaurants.seated(few, opening, 0.83, rng(1)), restaurants.seated(more, opening, 0.83, rng(1))
    calls, plain = [], np.logaddexp
    monkeypatch.setattr(restaurants.np, "logaddexp", lambda *a: calls.append(1) or plain(*a))
    assert (restaurants.seated(few, opening, 0.83, rng(1)) == first).all() and (restaurants.seated(more, opening, 0.83, rng(1)) == second).all() and not calls
    restaurants.seated(np.array([905]), opening[:1], 0.83, rng(1))
    assert len(calls) == 5
