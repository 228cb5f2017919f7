"""Operators on pairs and repeats against brute force, with nulls, empty and repeated rows and clashing columns."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from pagemill.llm import queries, repeats, simhash, substrings, suffixes, vectors
from pagemill.llm.vectors import Coder, link_vectors

DOCS = "doc_id long, text string, fp long, id long, component string"


def words(n, seed):
    r = random.Random(seed)
    return [r.choice(["alpha", "beta", "gamma", "delta", "Ünder", "x1", "zeta", "eta"]) + str(r.randrange(60)) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, shared passages, internal repeats, constant runs, blanks and nulls."""
    passage, r = words(70, 1), random.Random(5)
    out = [" ".join(words(120, i)) for i in range(8)] + [" ".join(words(120, 0))] * 3
    for i in range(6):
        w = words(150, 3)
        w[r.randrange(150)] = f"edit{i}"
        out.append(" ".join(w))
    for i in range(5):
        out.append(" ".join(words(30 + i, 50 + i) + passage + words(20 + i, 70 + i)))
    out += ["a" * 1500, "ab" * 600, " ".join(passage[:60] * 3), "", None, " \n\t ", "one", "one two", "é" * 500, "tail " * 130, "\x1c".join(words(100, 9))]
    return out


def docs(spark, texts):
    rows = [(i, t, 7, 9, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def removed_bytes(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + width] for t in data for i in range(len(t) - width + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("width", [400, 57, 12])
def test_repeated_bytes(spark, texts, width):
    found = {r.doc_id: tuple(r)[1:] for r in suffixes.remove_repeated_bytes(docs(spark, texts), width=width).collect()}
    assert [found[i] for i in range(len(texts))] == removed_bytes(texts, width)


def test_repeated_bytes_of_one_id_twice(spark):
    t = " ".join(words(200, 4))
    df = spark.createDataFrame([(1, t), (1, t), (None, "short"), (None, t[:450] + "!")], "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed) for r in suffixes.remove_repeated_bytes(df).collect())
    assert got == sorted(x[:2] for x in removed_bytes([t, t, "short", t[:450] + "!"], 400))


def removed_words(texts, width):
    split = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    first = {}
    for i, w in enumerate(split):
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k : k + width]), i)
    out = []
    for i, w in enumerate(split):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("width", [50, 7, 4])
def test_repeated_words(spark, texts, width):
    found = {r.doc_id: tuple(r)[1:] for r in substrings.remove_repeated_words(docs(spark, texts), width=width).collect()}
    assert [found[i] for i in range(len(texts))] == removed_words(texts, width)


def test_repeated_words_of_equal_and_null_ids(spark):
    t = " ".join(words(80, 4))
    df = spark.createDataFrame([(5, t), (5, t), (None, t), (7, t)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in substrings.remove_repeated_words(df).collect())
    assert got == [(0, 0), (5, 0), (5, 0), (7, 80)]


def test_multikey_quicksort():
    r = np.random.default_rng(0)
    keys = [r.integers(-3, 3, 20_000), r.integers(-9, 9, 20_000), r.integers(0, 5, 20_000)]
    order = suffixes.multikey_quicksort(keys)
    assert sorted(order) == list(range(20_000))
    rows = [tuple(k[i] for k in keys) for i in order]
    assert rows == sorted(rows)


def test_equal_suffixes_over_many_buckets(spark, tmp_path):
    """One passage in all texts, over more buckets than distinct rows: ends of buckets are compared."""
    texts = [f"{i:03d} " + "shared passage of text " * 30 + f"{i * 7919:06d}" for i in range(60)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        found = {r.doc_id: tuple(r)[1:] for r in suffixes.remove_repeated_bytes(docs(spark, texts)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [found[i] for i in range(60)] == removed_bytes(texts, 400)


def test_anchors_of_long_texts_in_pieces():
    values = repeats.mix(np.arange(5000, dtype=np.uint64) % np.uint64(700))
    whole = sum(repeats.anchor_runs(values, np.array([0, 5000]), 50, 20)[2])
    cut = sum(sum(repeats.anchor_runs(v, o, 50, 20)[2]) for v, o, _ in repeats.pieces(values, np.array([0, 5000]), 50, 300))
    assert whole == cut == 4951


def fingerprint(text, k=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    g = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] if w else []
    h = [xxhash.xxh64(x, seed=42).intdigest() for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(n, linked):
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return [top(i) for i in range(n)]


def test_fingerprints_and_components(spark, texts):
    found = {r.doc_id: r for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    prints = [fingerprint(t) for t in texts]
    assert [found[i].fp & (1 << 64) - 1 for i in range(len(texts))] == prints
    assert [found[i].component for i in range(len(texts))] == classes(len(texts), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)


def test_links_of_crowded_neighbourhoods(spark):
    """Chains and balls of fingerprints, more than a key may hold."""
    r = random.Random(1)
    prints = {0, (1 << 64) - 1, 1 << 63}
    for centre in (r.getrandbits(64), r.getrandbits(64)):
        prints |= {centre ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(300)}
    prints |= {r.getrandbits(64) for _ in range(200)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    from pagemill.llm.common import Scratch, components

    scratch = Scratch(spark, "test")
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    root = {x.node: x.root for x in components(simhash.links_of(nodes, scratch), scratch).collect()}
    want = classes(len(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    groups = Counter(want)
    got = Counter(root.get(p, p) for p in signed)
    assert sorted(groups.values()) == sorted(got.values())


def test_golay_keys_meet():
    r = np.random.default_rng(2)
    x = r.integers(0, 1 << 23, 3000).astype(np.uint32)
    y = x ^ (1 << r.integers(0, 23, 3000)).astype(np.uint32)
    near = simhash.near_indices(x)
    assert (near == simhash.golay_index(y)[:, None]).any(axis=1).all()
    assert max(len(set(row)) for row in near.tolist()) <= 6


def test_vectors(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(40, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, base[:10] + r.normal(size=(10, 16)) * 0.02, base[:3], base[5:8] * 4]))]
    rows += [(100, [0.0] * 16), (101, None), (102, [float("nan")] + [1.0] * 15), (103, [None] + [1.0] * 15), (104, [1.0, 2.0]), (105, [1.0, 2.0]), (106, [float("inf")] * 16), (107, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as node", "'x' as v")
    found = {x.vec_id: (x.n_links, x.component_id) for x in vectors.link_vectors(df).withColumnRenamed("component", "component_id").collect()}
    good = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}

    def near(a, b):
        return len(good[a]) == len(good[b]) and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.95

    ids = sorted(good)
    links = {a: sum(near(a, b) for b in ids if b != a) for a in ids}
    comp = classes(len(ids), lambda a, b: near(ids[a], ids[b]))
    total = sum(links.values())
    assert sum(n for n, _ in found.values()) >= 0.9 * total
    wrong = [i for k, i in enumerate(ids) if found[i] != (links[i], ids[comp[k]])]
    assert len(wrong) <= 0.1 * len(ids)
    assert all(found[i] == (0, i) for i in (100, 101, 102, 103, 106, 107))
    assert found[104] == (1, 104) and found[105] == (1, 104)


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.vec_id: r.n_links for r in queries.QUERIES["op10_embedding_near_dedup"](spark, sf).collect()}
    t = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    v = np.array(t.embedding.tolist(), float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = dict(zip(t.vec_id, (v @ v.T >= 0.95).sum(axis=1) - 1, strict=True))
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.9 * sum(want.values())


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert not suffixes.remove_repeated_bytes(none).collect()
    assert not substrings.remove_repeated_words(none).collect()
    assert not simhash.near_duplicates(none).collect()
    assert not vectors.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect()


def vectors_about(rng, n, dims, mean):
    """Unit vectors whose random pairs have that mean cosine, by a direction common to all."""
    z = rng.normal(size=(n, dims))
    v = np.sqrt(1 - mean) * z / np.linalg.norm(z, axis=1, keepdims=True)
    v[:, 0] += np.sqrt(mean)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def beside(rng, v, cosine):
    side = rng.normal(size=v.shape)
    side -= (side * v).sum(axis=1, keepdims=True) * v
    return cosine * v + np.sqrt(1 - cosine**2) * side / np.linalg.norm(side, axis=1, keepdims=True)


@pytest.mark.parametrize("vectors,dims,mean", [(500, 64, 0.0), (500, 64, 0.5), (500, 64, 0.8), (500, 384, 0.0), (500, 384, 0.5), (500, 384, 0.8), (50_000, 64, 0.0), (50_000, 64, 0.5), (50_000, 64, 0.8), (50_000, 384, 0.5), (1_000_000, 64, 0.0), (1_000_000, 64, 0.5)])
def test_recall_of_the_tables(vectors, dims, mean):
    """Fresh pairs right at the cosine meet in a table, at every size and with a common direction."""
    rng = np.random.default_rng(3)
    coder = Coder(vectors_about(rng, min(vectors, 2000), dims, mean), vectors, 64)
    a = vectors_about(rng, 2000, dims, mean)
    assert (np.bitwise_count((coder.encode(a) ^ coder.encode(beside(rng, a, 0.95))).astype(np.uint64)) <= 1).any(axis=1).mean() >= 0.94


@pytest.mark.parametrize("vectors", [30_000_000, 1_000_000_000])
def test_recall_of_the_tables_of_very_many(vectors):
    rng = np.random.default_rng(4)
    coder = Coder(vectors_about(rng, 2000, 64, 0.0), vectors, 64)
    a = vectors_about(rng, 2000, 64, 0.0)
    assert (np.bitwise_count((coder.encode(a) ^ coder.encode(beside(rng, a, 0.95))).astype(np.uint64)) <= 1).any(axis=1).mean() >= 0.94


@pytest.mark.parametrize("mean", [0.0, 0.8])
def test_links_beside_a_common_direction(spark, mean):
    """600 pairs planted at 0.96 among 2000 vectors, against all pairs."""
    rng = np.random.default_rng(5)
    v = vectors_about(rng, 1400, 64, mean)
    v = np.concatenate([v, beside(rng, v[:600], 0.96)])
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(4)
    found = {r.vec_id: r.n_links for r in link_vectors(rows).collect()}
    want = (v @ v.T >= 0.95).sum(axis=1) - 1
    assert all(found[i] <= want[i] for i in range(2000))
    assert sum(found.values()) >= 0.95 * want.sum() > 1000


def test_planted_links_of_many_dimensions(spark):
    """Pairs planted at cosines from 0.93 to 0.99 among 3000 vectors, against all pairs."""
    rng = np.random.default_rng(8)
    v = rng.normal(size=(3000, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    cosine = rng.uniform(0.93, 0.995, 600)
    noise = rng.normal(size=(600, 64))
    noise -= (noise * v[:600]).sum(axis=1, keepdims=True) * v[:600]
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    v[600:1200] = cosine[:, None] * v[:600] + np.sqrt(1 - cosine**2)[:, None] * noise
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(4)
    found = {r.vec_id: r.n_links for r in link_vectors(rows).collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    assert all(found[i] <= want[i] for i in range(3000)) and want.sum() > 700
    assert sum(found.values()) >= 0.95 * want.sum()
