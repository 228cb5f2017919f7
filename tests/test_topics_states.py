"""Topics with offsets, binary records, the trigram index and stateful streams, on small rows."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from pagemill.functions import msgpack
from pagemill.operators import trigrams
from pagemill.sources import topics
from pagemill.streaming import states


def messages(spark, ids):
    return spark.createDataFrame([(f"k{i % 7}", str(i).encode(), datetime.datetime(2024, 1, 1)) for i in ids], "key string, value binary, time timestamp").repartition(3)


def run(spark, root, group, checkpoint, seen, fail=False):
    """Consumes what there is; ``fail`` breaks the first batch after it was looked at."""

    def see(batch, i):
        rows = [(r.partition, r.offset, int(bytes(r.value))) for r in batch.collect()]
        if fail:
            raise RuntimeError("lost")
        seen.extend(rows)

    q = topics.consume(spark, root, "t", group).writeStream.option("checkpointLocation", f"{root}/{checkpoint}").foreachBatch(see).trigger(availableNow=True).start()
    q.awaitTermination()


def test_groups_resume(spark, tmp_path):
    root = f"file://{tmp_path}"
    topics.produce(messages(spark, range(50)), root, "t", 3)
    one, two = [], []
    with pytest.raises(Exception, match="lost"):
        run(spark, root, "one", "c1", one, fail=True)
    run(spark, root, "one", "c1", one)
    assert sorted(v for *_, v in one) == list(range(50))
    topics.produce(messages(spark, range(50, 80)), root, "t")
    assert sum(topics.lag(root, "t", "one").values()) in (30, 80)  # the last batch is committed with the next
    run(spark, root, "one", "c1", one)
    run(spark, root, "two", "c2", two)
    assert sorted(one) == sorted(two) and sorted(v for *_, v in two) == list(range(80))
    for p in range(3):
        assert sorted(o for q, o, _ in two if q == p) == list(range(sum(q == p for q, *_ in two)))


def test_unfinished_writes_are_not_read(spark, tmp_path):
    root = f"file://{tmp_path}"
    t = topics.Topic({"path": root, "topic": "t"})
    topics.register(spark)
    lost = t.write(iter(messages(spark, range(5)).toArrow().to_batches()))
    assert t.last()["next"] == {str(p): 0 for p in range(4)}
    t.remove(lost)
    again = [t.write(iter(messages(spark, range(5)).toArrow().to_batches())) for _ in range(2)]
    t.commit(again[0], "w", 3)
    t.commit(again[1], "w", 3)  # a batch that ran again
    assert sum(t.last()["next"].values()) == 5
    assert spark.read.format("topic").option("path", root).option("topic", "t").load().count() == 5


def test_stream_writer(spark, tmp_path):
    root = f"file://{tmp_path}"
    topics.produce(messages(spark, range(20)), root, "t")
    stream = topics.consume(spark, root, "t", "copy").select("key", "value", "time")
    stream.writeStream.format("topic").option("path", root).option("topic", "copy").option("writer", "w").option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.format("topic").option("path", root).option("topic", "copy").load()
    assert sorted(int(bytes(r.value)) for r in got.collect()) == list(range(20))


VALUES = [None, True, False, 0, 127, 128, -1, -32, -33, 2**63 - 1, -(2**63), 1.5, -math.inf, "", "é" * 20, "x" * 40, "y" * 70_000, b"", b"\0" * 300, [], [1, [2, "a"]], {"a": 1}, {str(i): i for i in range(20)}, list(range(70_000))]


def test_records_round_trip():
    for v in VALUES:
        reader = msgpack.Reader(memoryview(msgpack.packed(v)))
        got = reader.value()
        assert (dict(got) if isinstance(v, dict) else got) == v and reader.at == len(reader.data)
    when = datetime.datetime(1969, 12, 31, 23, 59, 59, 5, tzinfo=datetime.UTC)
    assert msgpack.Reader(memoryview(msgpack.packed(when))).value() == when


#: Records spelled out from the format's public description, and their values.
SPELLED = [(b"\xcc\xff", 255), (b"\xcd\x01\x00", 256), (b"\xce\x00\x01\x00\x00", 65536), (b"\xcf" + b"\xff" * 8, 2**64 - 1), (b"\xd0\x80", -128), (b"\xd1\x80\x00", -32768), (b"\xd2\x80\x00\x00\x00", -(2**31)), (b"\xca\x3f\xc0\x00\x00", 1.5), (b"\xd4\x05\x01", (5, b"\x01")), (b"\xc7\x03\x07abc", (7, b"abc")), (b"\xd6\xff\x00\x00\x00\x01", datetime.datetime(1970, 1, 1, 0, 0, 1, tzinfo=datetime.UTC)), (b"\x81\xa1a\x92\x01\xc0", [("a", [1, None])])]


def test_records_as_spelled():
    for data, v in SPELLED:
        assert msgpack.Reader(memoryview(data)).value() == v


def test_broken_records_say_why(spark):
    good = msgpack.packed({"a": 1, "more": [1]})
    bad = [None, b"", b"\xc1", good[:-1], good + good, msgpack.packed([1]), msgpack.packed({"a": "no"}), msgpack.packed({"a": 2**40}), b"\xdd\xff\xff\xff\xff", b"\x91" * 100, b"\xa2\xff\xff"]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate([good, msgpack.packed({}), *bad])], "id int, value binary")
    got = {r.id: r for r in msgpack.decode(rows, "value", "a int").collect()}
    assert got[0].record.a == 1 and got[0].error is None and got[1].record.a is None and got[1].error is None
    assert all(got[i].record is None and got[i].error for i in range(2, 2 + len(bad)))
    fine, dead = msgpack.split(msgpack.decode(rows, "value", "a int"))
    assert fine.count() == 2 and dead.count() == len(bad) and fine.columns == ["a"]


def grams(text):
    import re

    return {f"  {w} "[i : i + 3] for w in re.findall(r"[^\W_]+", (text or "").lower()) for i in range(len(w) + 1)}


TITLES = ["Hello world", "hello  World!", "Hello there world", "", None, "!!", "a", "A b", "completely different", "hallo welt", "Straße in München", "strasse in munchen"]


@pytest.mark.parametrize("threshold", [0.3, 0.75, 1.0])
def test_trigram_index(spark, tmp_path, threshold):
    rows = spark.createDataFrame(list(enumerate(TITLES)), "id long, title string")
    index = trigrams.TrigramIndex(spark, f"file://{tmp_path}/i", 8)
    index.add(rows.where("id < 6"), "one")
    index.add(rows.where("id >= 6"), "two")
    index.add(rows.where("id >= 6"), "two")  # again
    got = {(r.query_id, r.id): r.similarity for r in index.search(rows.selectExpr("id as query_id", "title as text"), threshold).collect()}
    g = [grams(t) for t in TITLES]
    want = {(a, b): len(x & y) / len(x | y) for a, x in enumerate(g) for b, y in enumerate(g) if x and y and len(x & y) / len(x | y) >= threshold}
    assert got == pytest.approx(want) and len(got) > 5


def test_trigram_search_reads_its_grams(spark, tmp_path):
    rows = spark.range(300).select("id", F.concat(F.lit("title number "), F.col("id") * 7919).alias("title"))
    index = trigrams.TrigramIndex(spark, f"file://{tmp_path}/i", 16)
    index.add(rows, "one")
    few = index.postings_of(spark.createDataFrame([("xyz",)], "gram string").withColumn("bucket", index.bucket()))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "PushedFilters: [IsNotNull(gram), EqualTo(gram,xyz)]" in plan
    assert few.count() == 0


DISCOVERED = [  # domain, kind, url, seed, depth, max_depth, max_pages
    ("d", "url", "a", None, 0, 3, 9), ("d", "url", "a", None, 0, 3, 9), ("d", "url", "b", None, 0, 3, 9), ("d", "url", "c", None, 0, 3, 9),
    ("d", "url", "e", "s", 4, 3, 9), ("d", "url", "e", "s", 3, 3, 1), ("d", "url", "f", "s", 0, 3, 1), ("e", "url", "a", None, 0, 3, 9),
    ("d", "reset", None, None, 0, 0, 0), ("d", "url", "a", None, 0, 3, 9), ("d", "url", "f", "s", 0, 3, 1),
]
OUTCOMES = ["added", "dedup_pending", "added", "domain_limit", "scope_depth_limit", "added", "scope_page_limit", "added", "reset", "added", "added"]


@pytest.mark.parametrize("cuts", [[11], [3, 8, 11]])
def test_discovery_however_cut(spark, tmp_path, cuts):
    ddl = "domain string, kind string, url string, seed string, depth int, max_depth int, max_pages int, arrival long"
    rows = [(*r, i) for i, r in enumerate(DISCOVERED)]
    first = 0
    for k, end in enumerate(cuts):
        spark.createDataFrame(rows[first:end][::-1], ddl).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/part={k}")
        first = end
        stream = spark.readStream.schema(ddl + ", part int").parquet(f"{tmp_path}/in").drop("part")
        states.start_states(states.discover(stream, 2), f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    got = sorted(spark.read.parquet(f"{tmp_path}/out").collect(), key=lambda r: r.arrival)
    assert [r.outcome for r in got] == OUTCOMES


def test_claims_partition_the_queue(spark, tmp_path):
    ddl = "shard int, kind string, url string, queue string, priority int, batch long, size int, arrival long"
    steps = [
        [(0, "add", "x", "priority_low", 9, None, None), (0, "add", "y", "priority_high", 1, None, None), (0, "add", "z", "priority_low", 9, None, None), (0, "claim", None, None, None, 1, 2), (1, "claim", None, None, None, 1, 2)],
        [(0, "add", "y", "priority_high", 9, None, None), (0, "done", "y", None, None, None, None), (0, "back", "x", "priority_low", 1, None, None), (0, "claim", None, None, None, 2, 1), (0, "add", "y", "priority_high", 9, None, None), (0, "claim", None, None, None, 3, 5), (0, "claim", None, None, None, 4, 5)],
    ]
    n = 0
    for k, step in enumerate(steps):
        rows = [(*r, n + i) for i, r in enumerate(step)]
        n += len(rows)
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/in/part={k}")
        stream = spark.readStream.schema(ddl + ", part int").parquet(f"{tmp_path}/in").drop("part")
        states.start_states(states.claims(stream), f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    got = sorted((r.batch, r.position, r.url) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(1, 1, "y"), (1, 2, "x"), (2, 1, "z"), (3, 1, "x")]


def test_retries_come_when_due(spark, tmp_path):
    ddl = "url string, success boolean, recoverable boolean, at timestamp"
    t0 = datetime.datetime(2024, 1, 1)

    def at(m):
        return t0 + datetime.timedelta(minutes=m)

    steps = [
        [("a", False, True, at(0)), ("b", False, False, at(0)), ("c", False, True, at(0)), ("c", True, True, at(10)), ("a", False, True, at(35)), ("z", True, True, at(40))],
        [("a", False, True, at(66)), ("a", False, True, at(97)), ("z", True, True, at(200))],
        [("z", True, True, at(201))],
    ]
    for k, step in enumerate(steps):
        spark.createDataFrame(step, ddl).coalesce(1).write.parquet(f"{tmp_path}/in/part={k}")
        stream = spark.readStream.schema(ddl + ", part int").parquet(f"{tmp_path}/in").drop("part")
        states.start_states(states.retries(stream), f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    got = sorted((r.url, r.due // 60_000 - int(t0.replace(tzinfo=datetime.UTC).timestamp()) // 60, r.attempt) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [("a", 30, 1), ("a", 65, 2), ("a", 96, 3)]


def test_run_statistics(spark, tmp_path):
    """Counters go on after a restart, a batch told twice counts once, and nulls are no failures."""
    from pagemill.plans import metrics
    from pagemill.streaming import statistics

    root = f"file://{tmp_path}/s"
    schema = "id long, success boolean, response_time double"

    def run(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        listener = statistics.RunStatistics(spark, f"{root}/told", "results")
        spark.streams.addListener(listener)
        try:
            rows = spark.readStream.schema(schema).parquet(f"{root}/in")
            seen = statistics.observed(rows, "results", statistics.result_metrics())
            seen.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start().awaitTermination()
            assert listener.done.wait(60)
        finally:
            spark.streams.removeListener(listener)
        return {r.name: r.value for r in metrics.instant(statistics.samples(spark, f"{root}/told"), []).collect()}

    assert run([(1, True, 0.5), (2, False, None), (3, None, 1.0)]) == {"processed_total": 3, "succeeded_total": 1, "failed_total": 1, "seconds_total": 1.5}
    assert run([(4, True, 0.25)]) == {"processed_total": 4, "succeeded_total": 2, "failed_total": 1, "seconds_total": 1.75}
    told = statistics.samples(spark, f"{root}/told").where("name = 'processed_total'").orderBy("value").collect()
    assert [r.value for r in told if r.value] == [3, 4] and len({r.run for r in told}) == 1
