"""Near-duplicate embeddings through iterative quantisation.

A rotation is learned that turns centred vectors into balanced binary codes; it is fitted on a bounded
sample, and every vector is indexed. Codes are cut into parts, one hash table each, probed within one
bit (multi-index hashing). Whoever meets in a table is reranked with the original vectors: links are
exact cosines in double precision. A pair is counted only in the first table where it meets.

Equal vectors are one node with a weight from the start. A crowded bucket is dealt out as a grid of
bounded blocks, so no task holds a bucket; blocks return link counts and a spanning forest of their
links, never their pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, apart, arrow_map, components, sampled, schema_of

#: Rows of the fitting sample, turns of the rotation, side of a block.
SAMPLE_ROWS, TURNS, SIDE = 20_000, 40, 1024
#: The share of planted pairs that the tables must find, how many are planted, and the most rotations that are tried for it.
RECALL, PLANTED, MOST_ROTATIONS = 0.97, 4000, 400


def learn_rotation(sample: np.ndarray, bits: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(mean, matrix) so that the signs of (x - mean) @ matrix are the code."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    values, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, np.argsort(values)[::-1][:bits]]
    low = centred @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(axes.shape[1],) * 2))[0]
    for _ in range(TURNS):
        u, _, vt = np.linalg.svd(np.where(low @ turn >= 0, 1.0, -1.0).T @ low)
        turn = (u @ vt).T
    return mean, axes @ turn


def usable(vector: str = "v"):
    """Whether a vector is not null, has only finite components and is not zero."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & ok & F.exists(vector, lambda x: x != 0)


def unit(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    v = flat.reshape(len(column), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def linked_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of links (a[i], b[i]), as (node, root) pairs."""
    nodes, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = both[: len(a)], both[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], least)
        np.minimum.at(new, root[y], least)
        new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def planted(kept: np.ndarray, cosine: float, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """``PLANTED`` pairs: vectors, repeated where there are fewer, and partners at exactly that cosine, in random directions."""
    rng = np.random.default_rng(seed)
    x = kept[np.arange(PLANTED) % len(kept)]
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-300)
    return x, cosine * x + np.sqrt(1 - cosine * cosine) * side


class Coder:
    """Rotations learned from a sample of unit vectors, and the parts of codes that are keys of the tables.

    Tables widen with the number of vectors, so that buckets keep their size; their number follows from what they find: rotations are added until ``RECALL`` of
    pairs planted at the wanted cosine meet in a table. They are planted beside a quarter of the sample from which no rotation is learned. Vectors with a common direction, whose centred codes differ more, so get more tables.
    """

    def __init__(self, sample: np.ndarray, vectors: int, bits: int, cosine: float = 0.95):
        self.width = min(max(16, int(vectors).bit_length() + 2), 28, bits)
        self.each = max(1, bits // self.width)
        self.learned, self.recall = [], 0.0
        aside = np.arange(len(sample)) % 4 == 0 if len(sample) > 8 else np.zeros(len(sample), bool)
        x, y = planted(sample[aside] if aside.any() else sample, cosine)
        met = np.zeros(len(x), bool)
        while self.recall < RECALL and len(self.learned) < MOST_ROTATIONS:
            rotation = learn_rotation(sample[~aside], bits, 7 + len(self.learned))
            self.learned.append(rotation)
            met |= (np.bitwise_count((self.parts(x, rotation) ^ self.parts(y, rotation)).astype(np.uint64)) <= 1).any(axis=1)
            self.recall = float(met.mean())
        if self.recall < RECALL:
            raise ValueError(f"{MOST_ROTATIONS} rotations find only {self.recall:.3f} of pairs at cosine {cosine}")
        self.tables = len(self.learned) * self.each

    def parts(self, v: np.ndarray, rotation: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        mean, matrix = rotation
        code = ((v - mean) @ matrix >= 0)[:, : self.each * self.width].astype(np.int64)
        return (code.reshape(len(v), self.each, -1) << np.arange(code.shape[1] // self.each)).sum(axis=2)

    def encode(self, v: np.ndarray) -> np.ndarray:
        """The codes' parts as integers, one column a table."""
        return np.concatenate([self.parts(v, rotation) for rotation in self.learned], axis=1)


def link_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95, bits: int = 64) -> DataFrame:
    """One row per vector: (id, n_links, component), component the smallest id reachable over links.

    Links are true ones; of pairs right at ``cosine`` the tables find ``RECALL`` by their own measure on planted pairs, of nearer ones more. An error says
    so where no number of tables does.

    Null and zero vectors and those with null or non-finite components have no links and are their own
    component. Vectors of different lengths are compared only with their like. Repeated rows are
    vectors of their own and link with each other. A null id is its own component only where all in it
    are null. Other columns are ignored; an empty table gives an empty one.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "vectors")
    every = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    good = every.where(usable())
    nodes = scratch.put(good.groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("weight")).withColumn("node", F.xxhash64("v")))
    dims = [r.d for r in nodes.select(F.size("v").alias("d")).distinct().collect()]  # lengths of vectors, a handful
    counts = forests = None
    for d in sorted(dims):
        own = nodes.where(F.size("v") == d)
        c, f = _link_length(own, scratch, cosine, bits, d)
        counts = c if counts is None else counts.union(c)
        forests = f if forests is None else forests.union(f)
    if counts is None:
        return every.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    roots = components(forests, scratch)
    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = named.join(apart(named.groupBy("root").agg(F.min("least").alias("component")), "root"), "root")
    named = named.join(counts.groupBy("node").agg(F.sum("n").alias("n")), "node", "left")
    named = named.select("node", "component", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    marked = every.withColumn("node", F.when(usable(), F.xxhash64("v"))).select("id", "node")
    joined = marked.join(apart(named, "node"), "node", "left")  # so that a very common vector can be split
    return joined.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component"))


def _link_length(nodes: DataFrame, scratch: Scratch, cosine: float, bits: int, d: int) -> tuple[DataFrame, DataFrame]:
    """(node, n) link counts, to be summed, and links (u, v) of a spanning forest, for vectors of one length."""
    total = nodes.count()
    # A share first: a limit alone would bring its number of rows from every partition together.
    few = nodes.where(sampled(2 * SAMPLE_ROWS / max(1, total), "node"))
    sample = few.orderBy(F.xxhash64("node")).limit(SAMPLE_ROWS).select("v").toPandas()["v"]
    base = unit(pa.array(list(sample), pa.list_(pa.float64())))
    coder = Coder(base, total, min(bits, d), cosine)
    encode, tables = coder.encode, coder.tables
    flips = np.concatenate([[0], 1 << np.arange(coder.width)])

    def probe(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = encode(unit(batch.column(1)))
        n = len(p)
        key = (np.arange(tables)[None, :, None] << 40) | (p[:, :, None] ^ flips[None, None, :])
        row = np.repeat(np.arange(n), key[0].size)
        own = np.broadcast_to(np.arange(len(flips)) == 0, key.shape).ravel()
        return pa.RecordBatch.from_arrays([pa.array(key.ravel()), batch.column(0).take(pa.array(row)), pa.array(own)], ["key", "node", "own"])

    probes = arrow_map(nodes.select("node", "v"), probe, "key bigint, node bigint, own boolean")
    sizes = probes.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.col("own").cast("long")).alias("m")).where("n > 1 and m > 0")
    met = scratch.put(probes.join(apart(sizes, "key"), "key"))
    # Blocks: own members by chunks, probes by chunks; chunk numbers come from the node, sizes stay near SIDE.
    rows_n = F.ceil(F.col("m") / SIDE).cast("int")
    cols_n = F.ceil(F.col("n") / SIDE).cast("int")
    place = F.col("node").bitwiseAND(F.lit(0x7FFFFFFF))
    mine = met.where("own").select("key", F.pmod(place, rows_n).cast("int").alias("a"), F.explode(F.sequence(F.lit(0), cols_n - 1)).alias("b"), "node", F.lit(True).alias("own"))
    theirs = met.select("key", F.explode(F.sequence(F.lit(0), rows_n - 1)).alias("a"), F.pmod(place, cols_n).cast("int").alias("b"), "node", F.lit(False).alias("own"))
    dealt = mine.union(theirs).join(nodes.select("node", "v", "weight"), "node")
    dealt = dealt.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")

    def blocks(batches):
        """Whole blocks of sorted batches."""
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t])
            k = [t.column(c).to_numpy() for c in ("key", "a", "b")]
            cuts = np.flatnonzero((k[0][1:] != k[0][:-1]) | (k[1][1:] != k[1][:-1]) | (k[2][1:] != k[2][:-1])) + 1
            if len(cuts):
                yield t.slice(0, cuts[-1]).combine_chunks(), cuts
                rest = t.slice(cuts[-1])
            else:
                rest = t
        if rest is not None and rest.num_rows:
            yield rest.combine_chunks(), np.array([rest.num_rows])

    def rerank(batches):
        for t, cuts in blocks(batches):
            key, node, own, weight = (t.column(c).to_numpy() for c in ("key", "node", "own", "weight"))
            v = unit(t.column("v").combine_chunks())
            p = encode(v)
            got_n, got_u, got_v = [], [], []
            for a, b in zip([0, *cuts[:-1]], cuts, strict=True):
                mine = np.flatnonzero(own[a:b]) + a
                theirs = np.flatnonzero(~own[a:b]) + a
                if len(mine) and len(theirs) > 0 and not (len(mine) == len(theirs) == 1 and node[mine[0]] == node[theirs[0]]):
                    close = v[mine] @ v[theirs].T >= cosine
                    close &= node[mine][:, None] != node[theirs][None, :]
                    i, j = np.nonzero(close)
                    if len(i):
                        x, y = mine[i], theirs[j]
                        table = int(key[a] >> 40)
                        differ = np.bitwise_count((p[x] ^ p[y]).astype(np.uint64)) <= 1
                        first = np.argmax(differ, axis=1) == table
                        x, y = x[first], y[first]
                        if len(x):
                            got_n.append((node[x], weight[y]))
                            nodes_, roots_ = linked_forest(node[x], node[y])
                            got_u.append(nodes_)
                            got_v.append(roots_)
            if got_n:
                who, n = (np.concatenate(z) for z in zip(*got_n, strict=True))
                who, at = np.unique(who, return_inverse=True)
                total = np.bincount(at, weights=n).astype(np.int64)
                u, w = np.concatenate(got_u), np.concatenate(got_v)
                yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(total), pa.array([None] * len(who), pa.int64())], ["u", "n", "v"])
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array([0] * len(u), pa.int64()), pa.array(w)], ["u", "n", "v"])

    found = scratch.put(dealt.mapInArrow(rerank, schema_of("u bigint, n bigint, v bigint")))
    return found.where("v is null").select(F.col("u").alias("node"), "n"), found.where("v is not null and u <> v").select("u", "v")
