"""Word model, fill-in-the-middle and filter audit against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import audit, infill, queries, restaurants

SF = "/root/testdata/sf0.001"
TEXTS = ["", None, " \n", "a\x01b\x02c\n\x02a\x02b\x01", "one line", "two\nlines", "x\n\n\ny", "has <P> in it\nand more", "<\nP>\n<S", "é\r\n東京\n" * 3, "tail\n", "\n" * 5, "long " * 30_000, "A B c a b\n" * 40, "w\x0bw\x0cw\x1cw"]


def table(spark, texts, copies=()):
    rows = [(i, t, f"s{i % 3}" if i % 4 else None, 7) for i, t in enumerate(texts)] + list(copies)
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n long").repartition(3)


def tokens(t):
    return [w.decode() for w in re.findall(rb"[^\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()))] + ["\n"]


# ---- op11 ----


def base_scores(rows):
    """(tokens, known, N, base score) of rows (learn, text)."""
    c = Counter(w for learn, t in rows if learn for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return [(len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for ws in (tokens(t) for _, t in rows)]


def test_base_scores_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    learn = [zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for r in docs]
    want = dict(zip((r.doc_id for r in docs), base_scores([(k, r.text) for k, r in zip(learn, docs, strict=True)]), strict=True))
    got = {r.doc_id: r for r in queries.QUERIES["op11_lm_scoring"](spark, SF).collect()}
    assert set(got) == set(want)
    for (i, (n, known, total, base)), k in zip(want.items(), learn, strict=True):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, not k)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.perplexity == pytest.approx(10 ** (-r.score / n))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_hard_texts(spark):
    docs = table(spark, TEXTS, [(2, "again", "x", 1), (2, "again", "x", 1), (None, "again", "y", 1)])
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in restaurants.score_texts(docs, F.col("n") == 7).collect())
    rows = [(True, t) for t in TEXTS] + [(False, "again")] * 3
    want = sorted((i is None, i or 0, n, k, round(b, 6)) for i, (n, k, _, b) in zip([*range(len(TEXTS)), 2, 2, None], base_scores(rows), strict=True))
    assert got == want
    nothing = restaurants.score_texts(docs, F.lit(False)).collect()
    assert all(r.score == pytest.approx(0) and r.n_known == 0 and r.train_tokens == 0 for r in nothing)
    assert restaurants.score_texts(docs.limit(0), F.lit(True)).collect() == []


def test_context_and_frequency_raise_probability(spark):
    """Words seen after a context beat those seen elsewhere, and these the unknown one."""
    words = ["a", "b", "a b", "b a a", "c", "a c b a", "B A"]
    known = ["a", "b", "c"]
    ask = [*known, "unknown", "a a", "a b", "a c", "a unknown", ""]
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(words)] + [(100 + i, t, False) for i, t in enumerate(ask)], "doc_id long, text string, learn boolean")
    p = {ask[r.doc_id - 100]: 10**r.score for r in restaurants.score_texts(docs, F.col("learn")).collect() if r.doc_id >= 100}
    assert p[""] + sum(p[w] for w in [*known, "unknown"]) < 1
    assert p["a b"] > p["a c"] > p["a unknown"] and p["a"] > p["unknown"]


def test_closed_form_where_every_table_has_one_customer(spark):
    """Pairs that occur once open one table each, and words with one predecessor too: every number is known."""
    docs = spark.createDataFrame([(0, "p q r", True), (1, "q z", False)], "doc_id long, text string, learn boolean")
    got = {r.doc_id: r.score for r in restaurants.score_texts(docs, F.col("learn")).collect()}
    d, d0, s, s0 = 0.95, 0.95, restaurants.STRENGTH, restaurants.PARENT_STRENGTH  # one pair of each kind: discounts at their bound
    parent = {w: (1 - d0 + (s0 + d0 * 4) / 5) / (s0 + 4) for w in ("p", "q", "r", "end")}
    unknown = (s0 + d0 * 4) / 5 / (s0 + 4)
    assert sum(parent.values()) + unknown == pytest.approx(1)
    after = (1 - d + (s + d) * parent["p"]) / (s + 1)
    assert got[0] == pytest.approx(4 * math.log10(after))
    seen = (s + d) / (s + 1)
    assert got[1] == pytest.approx(math.log10(seen * parent["q"]) + math.log10(seen * unknown) + math.log10(parent["end"]))


def tables_of(c, d, a):
    """The distribution of the number of tables of ``c`` customers, weights by all seatings."""
    ways = {1: a}
    for n in range(1, c):
        new = defaultdict(float)
        for t, w in ways.items():
            new[t] += w * (n - d * t)
            new[t + 1] += w * a
        ways = new
    total = sum(ways.values())
    return {t: w / total for t, w in ways.items()}


@pytest.mark.parametrize("c,d,a", [(2, 0.5, 0.3), (5, 0.8, 0.5), (12, 0.6, 2.0), (40, 0.8, 1.0)])
def test_seating_follows_the_posterior(c, d, a):
    got = restaurants.seated(np.full(20_000, c), np.full(20_000, a), d, np.random.default_rng(1), 8 * c)
    share = Counter(got.tolist())
    for t, p in tables_of(c, d, a).items():
        assert share[t] / 20_000 == pytest.approx(p, abs=0.02)


def test_packed_arrays():
    arrays = [np.sort(np.random.default_rng(0).integers(0, 2**64, 1000, dtype=np.uint64)), np.arange(5), np.array([1.5, -2.0]), np.array([7], np.uint8)]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, restaurants.unpack(restaurants.pack(*arrays)), strict=True))


# ---- op12 ----


def middle(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, None, text
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    return (len(units), "spm", p, m, s, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else (len(units), "psm", p, m, s, f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("rate", [100, 60])
def test_fill_in_middle(spark, rate):
    docs = table(spark, TEXTS * 4, [(3, "again\nand again", "x", 1), (3, "again\nand again", "x", 1), (None, "null\nid", "x", 1)])
    cut = infill.fill_in_middle(docs, rate=rate)
    got = cut.select("*", infill.restored(F.col("output"), F.col("form")).alias("again")).collect()
    want = [(i, *middle(i, t, rate)) for i, t in [*enumerate(TEXTS * 4), (3, "again\nand again"), (3, "again\nand again"), (None, "null\nid")]]
    assert sorted(map(repr, (tuple(r)[:-1] for r in got))) == sorted(map(repr, want))
    assert Counter(r.again for r in got) == Counter([t or "" for t in TEXTS * 4] + ["again\nand again"] * 2 + ["null\nid"])
    assert {w[2] for w in want} == {"plain", "spm", "psm"}


def test_fill_in_middle_of_the_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.QUERIES["op12_fill_in_middle"](spark, SF).collect():
        n, form, p, m, _, out = middle(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, None if p is None else len(p), None if m is None else len(m))
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest() and r.restored_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


# ---- op13 ----


def failed(rows):
    """The filters that each of rows (id, text, source) fails."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, t, _ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        tests = len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and first.get(t, i) < i
        out.append("".join(f for f, x in zip("ABCDE", tests, strict=True) if x))
    return out


def brute_audit(rows, labels):
    fails, out = failed(rows), {}
    parts = {s or "" for *_, s in rows}
    for part in parts:
        own = [(f, labels.get(i, (0, 0))) for (i, _, s), f in zip(rows, fails, strict=True) if (s or "") == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            kept = own
            for step, x in enumerate(order, 1):
                gone = [r for r in kept if x in r[0]]
                kept = [r for r in kept if x not in r[0]]
                shapley[x] += len(gone)
                out[part, order, step] = [len(kept), len(gone), sum(x in f for f, _ in own) - len(gone), sum(f == x for f, _ in own), sum(q == 1 for _, (q, _) in gone), sum(z == 1 for _, (_, z) in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def test_filter_audit(spark):
    good = " ".join(f"word{i}" for i in range(250))
    texts = [*TEXTS, good, good, good + " # x", "A" * 10 + good, good + "x", (good + " ") * 3, "", "Z z " * 150, None]
    copies = [(0, "zero again", "s1", 1), (0, "zero again", "s1", 1), (1, good, "", 1), (None, good, "s1", 1), (None, None, None, 1)]
    docs = table(spark, texts, copies)
    labels = {0: (1, 1), 1: (0, 1), 15: (1, 0), 16: (1, 1), 18: (None, 1), 22: (1, None)}
    frame = spark.createDataFrame([(i, *v) for i, v in labels.items()] + [(0, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in audit.audit_filters(docs, frame).collect()}
    rows = [(i, t, f"s{i % 3}" if i % 4 else None) for i, t in enumerate(texts)] + [c[:3] for c in copies]
    assert got == brute_audit(rows, labels)
    assert set("".join(failed(rows))) == set("ABCDE")
    assert audit.audit_filters(docs.limit(0), frame).collect() == []
    assert len(audit.audit_filters(docs, frame.limit(0)).collect()) == 600 * 4


def test_word_rows_are_not_shuffled(spark):
    plan = audit.failures(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    generate = plan[plan.index("Generate explode") :]
    above = plan[: plan.index("Generate explode")]
    assert "word" not in "".join(line for line in above.splitlines() if "Exchange" in line) and "Exchange hashpartitioning" in generate
