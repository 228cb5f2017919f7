"""What the findings of round 4 named, each by a case that failed before."""

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from pagemill import queries
from pagemill.functions import msgpack
from pagemill.streaming import states

from .test_findings_r03 import Counted, Value
from .test_whole_tables import same_rows


def test_documents_are_chunked_to_their_end(spark, tmp_path):
    """a document of more than twenty chunks gives all of them, and its SQL too."""
    text = "\n\n".join(f"Paragraph {i} " + "word " * 80 for i in range(33))
    got = same_rows(spark, tmp_path, "documents", spark.createDataFrame([(1, text), (2, text[:1000])], "doc_id long, text string"), "document_chunks")
    assert sorted(r[1] for r in got if r[0] == "doc:1") == list(range(33))
    assert [r[2] for r in got if r[:2] == ("doc:1", 32)] == [("Paragraph 32 " + "word " * 80).strip()]


def test_pages_are_embedded_to_their_end(spark, tmp_path):
    """a page of more than twenty chunks gives all of them, each with the vector of its own text."""
    page = "<html><body><article>" + "".join(f"<p>Paragraph {i} {'word ' * 80}</p>" for i in range(33)) + "</article></body></html>"
    spark.createDataFrame([(1, "https://x.org/1", page)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.chunk_vectors(spark, str(tmp_path)).orderBy("chunk_index").collect()
    assert [(r.chunk_index, r.chunk_text.split()[:2]) for r in got] == [(i, ["Paragraph", str(i)]) for i in range(33)]
    assert all(abs(sum(x * x for x in r.embedding) - 1) < 1e-5 for r in got) and got[32].embedding != got[31].embedding


def discovery(most):
    d = states.Discovery(most, None)
    d.seen, d.added, d.seeds = Counted(), Value(), Counted()
    return d


def found(k, url, seed=None, kind="url"):
    return Row(kind=kind, url=url, seed=seed, depth=0, max_depth=3, max_pages=1000, arrival=k)


def test_discovery_asks_nothing_of_a_state_that_it_cleared():
    """after a reset URLs and seeds are known to be new; only what is added costs a call."""
    d = discovery(1000)
    d.seen[("u5",)], d.seeds[("s",)], d.added.held = (0,), (9,), (3,)
    rows = [found(0, None, kind="reset"), *(found(k, f"u{k}", "s" if k % 9 == 0 else None) for k in range(1, 1001))]
    got = list(d.handleInputRows(("d",), iter(rows), None))
    assert [r.outcome for r in got] == ["reset"] + ["added"] * 1000 and got[9].pages == 1 and d.added.held == (889,)
    assert d.seen.calls == 1000 and d.seeds.calls == 1


def test_discovery_in_frames(spark, tmp_path):
    """numbers above what floats hold, URLs without limits, nulls and rows that come last first keep their outcomes, over several frames and batches."""
    big = 2**53 + 1
    ddl = "domain string, kind string, url string, seed string, depth long, max_depth long, max_pages long, arrival long"
    rows = [(None if k % 3 == 0 else f"d{k % 3}", "reset" if k % 50 == 49 else "url", None if k % 50 == 49 else f"u{k % 7}", "s" if k % 2 else None, big if k % 2 else None, big - k % 4 // 2 if k % 2 else None, 2 if k % 2 else None, big + k) for k in range(400)]
    want = {}
    for name in {r[0] for r in rows}:
        d = states.Discovery(3, None)
        d.seen, d.added, d.seeds = Counted(), Value(), Counted()
        own = [Row(**dict(zip(ddl.replace(",", "").split()[::2], r, strict=True))) for r in rows if r[0] == name]
        want |= {r.arrival: (r.domain, r.url, r.outcome, r.pages) for r in d.handleInputRows((name,), iter(own), None)}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 30)
    try:
        for k, part in enumerate((rows[:150], rows[150:])):
            spark.createDataFrame(part[::-1], ddl).coalesce(1).write.parquet(f"{tmp_path}/in/part={k}")
            stream = spark.readStream.schema(ddl + ", part int").parquet(f"{tmp_path}/in").drop("part")
            states.start_states(states.discover(stream, 3), f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {r.arrival: (r.domain, r.url, r.outcome, r.pages) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == want and {"added", "reset", "dedup_pending", "scope_depth_limit"} <= {o for *_, o, _ in got.values()}


ROW = [("key", "string"), ("n", "long"), ("small", "int"), ("tiny", "byte"), ("ok", "boolean"), ("x", "double"), ("at", "timestamp"), ("much", "string")]


def odd_rows(rng, n):
    texts = ["", "a", "\u00e9\u1e9e", "x" * 31, "x" * 32, "y" * 255, "z" * 256, "w" * 70_000, "\0", None]
    numbers = [0, 1, -1, -32, -33, 127, 128, 255, -128, None]
    first, last = -62135596800 * 10**6, 253402300799 * 10**6
    for _ in range(n):
        yield {
            "key": rng.choice(texts[:-3]), "n": rng.choice([*numbers, 2**63 - 1, -(2**63), 2**53 + 1]), "small": rng.choice([*numbers, 2**31 - 1, -(2**31)]), "tiny": rng.choice([*numbers[:6], -128, None]), "ok": rng.choice([True, False, None]),
            "x": rng.choice([0.0, -0.0, 1.5, math.inf, -math.inf, None, 5e-324]), "at": rng.choice([None, 0, -1, 999_999, 1_700_000_000_123_456, first + 1, last]), "much": rng.choice(texts),
        }


def as_before(column, kind, arrow):
    """What reading a record at a time gives."""
    fit, out = msgpack.fitter(kind), []
    for value in column:
        try:
            if not value.is_valid:
                raise ValueError("nothing")
            reader = msgpack.Reader(memoryview(value.as_buffer()).cast("B"))
            found = fit(reader.value())
            if found is None or reader.at < len(reader.data):
                raise ValueError("no record" if found is None else "more than a record")
            out.append((pa.array([found], arrow)[0].as_py(), None))
        except (ValueError, OverflowError) as e:
            out.append((None, str(e)))
    return out


class Messages:
    """A frame of one binary column, whose function is taken out."""

    schema, columns = T.StructType([T.StructField("value", T.BinaryType())]), ["value"]

    def mapInArrow(self, run, out):
        return run


@pytest.mark.parametrize("ddl", [", ".join(map(" ".join, ROW)), "much string, n long, no string", "n short, key string, ok boolean", "n double, at timestamp", "key binary", "n array<long>"])
def test_records_are_packed_and_read_as_columns(spark, ddl):
    """bytes, values and errors are those of one record at a time: of odd values, and of records that are cut, changed, missing or of another layout."""
    rng = random.Random(5)
    kind = T._parse_datatype_string(ddl)
    arrow = to_arrow_type(kind, timestamp_utc=True)
    sent = pa.Table.from_pylist(list(odd_rows(rng, 400)), to_arrow_schema(T._parse_datatype_string(", ".join(map(" ".join, ROW))), timestamp_utc=True)).combine_chunks().to_batches()[0]
    frame = type("Frame", (), {"schema": {}, "mapInArrow": lambda self, run, out: run})()
    got = next(msgpack.encode(frame)(iter([sent.slice(7)]))).column(0)
    assert got.to_pylist() == [msgpack.packed(r) for r in sent.slice(7).to_pylist()]
    few = [x for x in got.to_pylist() if len(x) < 2000]
    for share in (0.0, 0.05, 0.9):
        held = [few[0]]
        for x in few[1:]:
            how = rng.random()
            if rng.random() < share:
                x = bytearray(x)
                if how < 0.3:
                    x = x[: rng.randrange(len(x))]
                elif how < 0.7:
                    x[rng.randrange(len(x))] = rng.choice([0, 0x7F, 0xC0, 0xC2, 0xD3, 0xD9, 0xDA, 0xDB, 0xA0, 0xBF, 0xFF, 0xCC])
                elif how < 0.8:
                    x += b"\0"
                elif how < 0.9:
                    x = msgpack.packed({"n": 5, "key": "k", "more": [1]})
                else:
                    x = None
            held.append(None if x is None else bytes(x))
        column = pa.array([b"before", *held], pa.binary()).slice(1)
        out = next(msgpack.decode(Messages(), "value", ddl)(iter([pa.RecordBatch.from_arrays([column], ["value"])])))
        want = as_before(column, kind, arrow)
        assert repr([(r, e) for r, e in zip(out.column(1).to_pylist(), out.column(2).to_pylist(), strict=True)]) == repr(want)
    left = msgpack._alike(pa.array(few, pa.binary()), kind, arrow)
    assert left is None if any(isinstance(f.dataType, (T.ArrayType, T.BinaryType)) for f in kind) else left[0].mean() > (0.5 if "key string, n" in ddl else 0)


def test_many_urls_meet_a_small_state_in_one_pass():
    """F2: a state of fewer URLs than a micro-batch asks for is read through, a larger one is not."""
    d = discovery(40)
    d.seen[("u7",)], d.added.held = (0,), (1,)
    got = [r.outcome for r in d.handleInputRows(("d",), iter([found(k, f"u{k}") for k in range(1000)]), None)]
    assert got[7] == "dedup_pending" and got.count("added") == 39 and got.count("domain_limit") == 960 and d.seen.calls == 1 + 39
    d = discovery(10**9)
    d.seen.update({(f"v{k}",): (0,) for k in range(5000)} | {("u99",): (0,)})
    assert d.known({f"u{k}" for k in range(100)}) == {"u99"} and d.known({"u1", "u99", "v3"}) == {"u99", "v3"}
