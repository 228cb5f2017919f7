"""Registered queries and the pipeline's stages on whole tables against brute force."""

import hashlib
import re
from collections import Counter

import pytest

import corpus_pipeline
from pagemill.llm import decontaminate, languages, quality, queries, secrets
from pagemill.llm.common import sampled

from .test_pairs import classes, fingerprint
from .test_rows import check_packing, tokenizer  # noqa: F401
from .test_shingles import first_of_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_suffix_query(spark, documents):
    """Every window of 400 bytes of the table."""
    texts = {i: (t or "").encode() for i, t in documents.items()}

    def windows(t):
        return [hashlib.blake2b(t[k : k + 400], digest_size=12).digest() for k in range(len(t) - 399)]

    seen = Counter(w for t in texts.values() for w in windows(t))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op2_suffix_array_dedup(spark, SF).collect()}
    assert set(got) == set(texts) and any(n for _, n, *_ in got.values())
    for i, t in texts.items():
        gone = bytearray(len(t))
        for k, w in enumerate(windows(t)):
            if seen[w] > 1:
                gone[k : k + 400] = b"\1" * 400
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        assert got[i] == (len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())


def test_simhash_query(spark, documents):
    ids = sorted(documents)
    prints = [fingerprint(documents[i]) for i in ids]
    groups = classes(len(ids), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op4_simhash_near_dedup(spark, SF).collect()}
    assert got == {i: (f"{prints[k]:016x}", ids[groups[k]]) for k, i in enumerate(ids)}


def test_leak_query(spark, documents):
    """Half the items against every whole text, by the distance to all of its stretches."""
    items = {r.item_id: decontaminate.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").where("item_id % 2 = 0").collect()}
    got = {(r.doc_id, r.item_id): r.distance for r in queries.op7_benchmark_decontamination(spark, SF).collect() if r.item_id in items}
    want = {}
    for d, t in documents.items():
        text = decontaminate.normal(t)
        for i, item in items.items():
            distance, _ = decontaminate.myers(item, text)
            if distance <= int(len(item) * 0.05):
                want[d, i] = distance
    assert got == want and want


def test_samples_of_very_large_tables(spark):
    """A share for 1e11 rows is not rounded to nothing, and shares are met."""
    rows = spark.range(4_000_000)
    for share in (1e-5, 0.25):
        n = rows.where(sampled(share, "id")).count()
        assert abs(n - share * 4e6) < 6 * (share * 4e6) ** 0.5 + 1
    for most in (languages.FIT_ROWS, quality.FIT_ROWS):
        assert int(most / 1e11 * (1 << 63)) > 1e11
    assert rows.where(sampled(1.0, "id")).count() == 4_000_000


def test_pipeline_stages(spark, documents, tokenizer, tmp_path):  # noqa: F811
    """Each stage of the pipeline on what the one before kept."""
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), [documents]
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if k < 4:
            assert docs.columns == columns
            kept.append({r.doc_id: r.text for r in docs.collect()})
    language, near, clean, masked = kept[1:]
    assert language == {i: t for i, t in documents.items() if t and any(c.isalpha() for c in t)}
    ids = sorted(language)
    assert set(near) == {ids[k] for k in first_of_groups([language[i] for i in ids])}
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(item in decontaminate.normal(t) for t in clean.values() for item in items)
    for i in set(near) - set(clean):
        assert any(decontaminate.myers(item, decontaminate.normal(near[i]))[0] <= int(len(item) * 0.05) for item in items)
    assert set(masked) == set(clean)
    for i, t in masked.items():
        places = sorted((m.start(), m.end()) for rule in secrets.RULES for m in re.finditer(rule.pattern, clean[i]) if m.end(rule.group) - m.start(rule.group) >= rule.least)
        out, done = [], 0
        for a, b in places:
            if a >= done:
                out += [clean[i][done:a], "[SECRET]"]
            done = max(done, b)
        assert t == "".join([*out, clean[i][done:]])
    ids = sorted(masked)
    rows = docs.collect()
    assert {r.doc_id for r in rows} == set(ids)
    place = {i: k for k, i in enumerate(ids)}

    class Row:
        def __init__(self, r):
            self.__dict__ = r.asDict() | {"doc_id": place[r.doc_id]}

    check_packing([Row(r) for r in rows], [masked[i] for i in ids], tokenizer)
