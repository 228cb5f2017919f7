"""The stored inverted file against exact search: recall at its own number of lists, exactness within bounds, edges, batches, pruning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.operators.vector_index import VectorIndex, probes_for

SCHEMA = "id long, embedding array<float>"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in enumerate(vectors)], SCHEMA)


def nearest(vectors, q, k):
    v = np.asarray(vectors, float)
    s = v @ np.asarray(q, float) / np.linalg.norm(v, axis=1) / np.linalg.norm(q)
    return sorted(range(len(v)), key=lambda i: (-round(s[i], 9), i))[:k]


def asked(rows, every):
    return rows.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "embedding")


@pytest.mark.parametrize("kind", ["table", "clusters", "common"])
def test_recall(spark, tmp_path, kind):
    """At least 0.9 of the ten nearest by the trained number of lists, on the table's vectors, in clusters, and with a common direction."""
    rng = np.random.default_rng(3)
    if kind == "table":
        rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").cast("long").alias("id"), "embedding")
        vectors = [r.embedding for r in rows.orderBy("id").collect()]
    else:
        middle = rng.normal(size=(40, 32)) * 2
        vectors = (middle[rng.integers(0, 40, 2000)] if kind == "clusters" else 2.0) + rng.normal(size=(2000, 32))
        rows = frame(spark, vectors)
    index = VectorIndex(spark, f"file://{tmp_path}/{kind}")
    index.train(rows, k=10, target=0.95)
    index.add(rows, "all")
    got = {}
    for r in index.search(asked(rows, 20)).collect():
        got.setdefault(r.query_id, set()).add(r.id)
    right = sum(len(got[q] & set(nearest(vectors, np.asarray(vectors[q]), 10))) for q in got)
    assert len(got) == 100 and right >= 0.9 * 1000, (index.model[2], len(index.model[0]), right / 1000)
    if kind == "clusters":  # where vectors have places, few lists are read
        assert index.model[2] * 3 <= len(index.model[0])


def test_all_lists_are_exact_with_coarse_codes(spark, tmp_path):
    """Steps learned on near vectors leave far ones with codes that say little: their bounds are wide, and results stay exact."""
    rng = np.random.default_rng(5)
    vectors = np.vstack([rng.normal(size=(200, 16)) * 0.05 + 1, rng.normal(size=(200, 16)) * 3])
    rows = frame(spark, vectors)
    index = VectorIndex(spark, f"file://{tmp_path}/x")
    index.train(rows.where("id < 200"), lists=4)
    index.add(rows, "all")
    got = {}
    for r in index.search(asked(rows, 10), k=7, probes=4).orderBy("query_id", F.desc("similarity"), "id").collect():
        got.setdefault(r.query_id, []).append(r.id)
    assert got == {q: nearest(vectors, vectors[q], 7) for q in range(0, 400, 10)}


def test_edges(spark, tmp_path):
    """Vectors without direction or of another length are not found; copies tie by id; huge components are no overflow; an empty batch is none."""
    good = [[1, 0, 0, 0], [1, 0, 0, 0], [2, 0, 0, 0], [0, 1, 0, 0], [1e30, 1e30, 0, 0]]
    bad = [None, [0, 0, 0, 0], [1, None, 0, 0], [float("nan"), 1, 0, 0], [float("inf"), 1, 0, 0], [1, 0], []]
    rows = frame(spark, good + bad)
    index = VectorIndex(spark, f"file://{tmp_path}/x")
    index.train(rows, lists=2)
    index.add(rows.where("false"), "none")
    assert index.search(asked(rows, 1), k=2).count() == 0
    index.add(rows, "some")
    got = [(r.query_id, r.id) for r in index.search(asked(rows, 1), k=3, probes=2).orderBy("query_id", F.desc("similarity"), "id").collect()]
    assert [i for q, i in got if q == 0] == [0, 1, 2] and [i for q, i in got if q == 4][0] == 4
    assert {q for q, _ in got} == {0, 1, 2, 3, 4} and {i for _, i in got} <= set(range(5))
    with pytest.raises(ValueError):
        VectorIndex(spark, f"file://{tmp_path}/y").train(rows.where("id in (5, 6, 7, 8, 9)"))


def test_batches_and_pruning(spark, tmp_path):
    """A batch that is added again replaces itself, another session sees all batches, and few queries read few lists."""
    rng = np.random.default_rng(8)
    middle = rng.normal(size=(20, 16)) * 4
    vectors = middle[np.arange(600) % 20] + rng.normal(size=(600, 16)) * 0.1
    rows = frame(spark, vectors)
    path = f"file://{tmp_path}/x"
    index = VectorIndex(spark, path)
    index.train(rows, lists=20)
    for batch, where in (("a", "id < 300"), ("b", "id >= 300"), ("b", "id >= 300")):
        index.add(rows.where(where), batch)
    other = VectorIndex(spark, path)
    assert other.table("codes").count() == 600 and other.table("vectors").count() == 600
    one = rows.where("id = 7").select(F.col("id").alias("query_id"), "embedding")
    found = other.search(one, k=5, probes=1)
    assert [r.id for r in found.orderBy(F.desc("similarity")).collect()] == nearest(vectors, vectors[7], 5)
    near = other.nearest_lists(one, 1, "query_id", "embedding")
    codes = other.codes_of(near)
    plan = codes._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(list_id" in plan
    files = [r[0] for r in codes.select(F.input_file_name()).distinct().collect()]
    assert len(files) < len(other.table("codes").inputFiles()) and len({f.split("list_id=")[1].split("/")[0] for f in files}) == 1


def test_fewest_lists():
    """Two far pairs of places: what is near lies in a query's own list, so one is enough."""
    rng = np.random.default_rng(2)
    angle = np.where(np.arange(900) % 2, 0.0, np.pi) + rng.normal(size=900) * 0.01
    units = np.stack([np.cos(angle), np.sin(angle)], 1)
    assert probes_for(units, np.array([[1.0, 0.0], [-1.0, 0.0]]), 10, 0.95) == (1, 1.0)
