"""Near-duplicates by the Jaccard similarity of word shingles, for ``simhash.near_duplicates`` with a ``similarity``.

SimHash fingerprints of the sets propose pairs first. Within two bits they find few pairs at 0.8, where about ten of 64 bits differ, so there
MinHash keys propose more; whole sets decide all pairs. A text is the set of its shingles' 64-bit hashes; equal sets
are one node from the start. A node has ``BANDS`` keys, each of ``ROWS`` minima over its set. A pair of
similarity s shares no key with probability (1 - s ** ROWS) ** BANDS: three in a million at 0.8, fewer above.

Nodes under one key first meet that one of them that meets most others in all, as the original among its
edited copies does. Only nodes that these links leave in different components go on, and they are joined
exactly, by prefix filtering: tokens are ordered by how few of the nodes hold them, two sets of the similarity
share one of their first tokens, and its places bound what they can share. So a group of near copies costs
its size and not the square of it, and no pair that shares a key is lost.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, Scratch, apart, arrow_map, components, utf8

BANDS, ROWS = 32, 5
_FACTORS = np.random.default_rng(42).integers(1 << 31, size=(BANDS * ROWS, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
#: Hashes of a set that meet all factors at a time, so that the products stay in a core's cache.
BLOCK = 1024


def shingle_set(text: bytes, words_in_shingle: int, seed: int = 42) -> np.ndarray:
    """Sorted distinct hashes of the shingles; one of the whole text when it is shorter, none without words."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, k, digest = b" ".join(words), words_in_shingle, xxhash.xxh64_intdigest
    if len(words) <= k:
        return np.array([digest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends.tolist()]
    return np.unique(np.array([digest(joined[s:e], seed) for s, e in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=False)], np.uint64))


def node_of(members: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(members.tobytes())


def band_keys(members: np.ndarray) -> np.ndarray:
    """One key a band of a set that is not empty; equal minima of a band give equal keys."""
    low = members.astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), BLOCK):
        np.minimum(least, (low[at : at + BLOCK] * _FACTORS).min(axis=1), out=least)
    rows = least.tobytes()
    return np.array([xxhash.xxh64_intdigest(rows[b * ROWS * 4 : (b + 1) * ROWS * 4], b) for b in range(BANDS)], np.uint64)


def similar(a, b, least: float) -> bool:
    """Whether two sorted sets, as bytes, have a Jaccard similarity of ``least`` or more."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(x) + len(y) - len(np.union1d(x, y))
    return both >= least * (len(x) + len(y) - both) - 1e-9


def _marked(docs: DataFrame, id_col: str, text_col: str, k: int, print_of: Callable[[np.ndarray], int] | None) -> DataFrame:
    """Rows (id, copy, node, n, fp, keys); ``copy`` is a hash of the text, ``fp`` the set's fingerprint."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        node, size, prints, keys = [], [], [], []
        for text in batch.column(2):
            members = shingle_set(text.as_py(), k)
            node.append(node_of(members))
            size.append(len(members))
            prints.append(print_of(members) if print_of else 0)
            # A set of one shingle equals another or has nothing in common with it.
            keys.append(band_keys(members) if len(members) > 1 else members[:0])
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys).view(np.int64)))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(node, np.uint64).view(np.int64)), pa.array(size, pa.int32()), pa.array(np.array(prints, np.uint64).view(np.int64)), lists], ["id", "copy", "node", "n", "fp", "keys"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(utf8(text_col)).alias("copy"), utf8(text_col).alias("text"))
    return arrow_map(rows, run, f"id {docs.schema[id_col].dataType.simpleString()}, copy bigint, node bigint, n int, fp bigint, keys array<bigint>")


def _sets(docs: DataFrame, text_col: str, copies: DataFrame, k: int) -> DataFrame:
    """Rows (node, members) of the texts whose hash is in ``copies``, each text once."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t.as_py(), k).tobytes() for t in batch.column(0)]
        node = np.array([xxhash.xxh64_intdigest(s) for s in sets], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(sets, pa.binary())], ["node", "members"])

    texts = docs.select(utf8(text_col).alias("text")).withColumn("copy", F.xxhash64("text"))
    once = texts.join(copies, "copy", "left_semi").dropDuplicates(["copy"])
    return arrow_map(once.select("text"), run, "node bigint, members binary")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose sets are similar."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = batch.column(2), batch.column(3)
        return batch.select([0, 1]).filter(pa.array([similar(x.as_buffer(), y.as_buffer(), least) for x, y in zip(a, b, strict=True)], pa.bool_()))

    left = sets.select(F.col("node").alias("u"), F.col("members").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("members").alias("b"))
    sizes = F.octet_length("a"), F.octet_length("b")
    fit = F.least(*sizes) >= F.greatest(*sizes) * F.lit(least) - F.lit(1e-6)
    return arrow_map(pairs.join(left, "u").join(right, "v").where(fit).select("u", "v", "a", "b"), run, "u bigint, v bigint")


def _unlinked(nodes: DataFrame, sets: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """Pairs (u, v), u > v, of nodes (node, root) with different roots that may be similar: all that are, few others."""
    share = float(least)

    def tokens(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
        size = np.array([len(x) for x in found], np.int64)
        row = pa.array(np.repeat(np.arange(len(found)), size))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), batch.column(0).take(row), pa.array(size).take(row)], ["token", "node", "n"])

    held = sets.join(nodes.select("node"), "node", "left_semi").select("node", "members")
    rows = arrow_map(held, tokens, "token bigint, node bigint, n bigint")
    often = rows.groupBy("token").agg(F.count("*").alias("often")).where("often > 1")
    common = rows.join(apart(often, "token"), "token")
    # Tokens of one node only come first of all and meet nobody; they are counted, not kept.
    of_node = Window.partitionBy("node")
    place = F.col("n") - F.count("*").over(of_node) + F.row_number().over(of_node.orderBy("often", "token")) - 1
    prefix = F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1
    kept = common.select("token", "node", "n", place.alias("place")).where(F.col("place") < prefix)
    kept = scratch.put(kept.join(apart(nodes, "node"), "node").select("token", "node", "root", "n", "place"))
    u, v = (kept.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "root", "n", "place")]) for side in "uv")
    needed = F.ceil((F.col("n_u") + F.col("n_v")) * (share / (1 + share)) - 1e-9)
    most = F.least(F.col("n_u") - F.col("place_u"), F.col("n_v") - F.col("place_v"))
    fit = F.least("n_u", "n_v") >= F.greatest("n_u", "n_v") * share - 1e-6
    met = u.join(v, "token").where((F.col("node_u") > F.col("node_v")) & (F.col("root_u") != F.col("root_v")) & (most >= needed) & fit)
    out = scratch.put(met.select(F.col("node_u").alias("u"), F.col("node_v").alias("v")).distinct())
    scratch.drop(kept)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = 5, least: float = 0.8, print_of: Callable[[np.ndarray], int] | None = None, propose: Callable[[DataFrame, Scratch], DataFrame] | None = None) -> DataFrame:
    """One row per document: (id, node, fp, component), component the smallest id reachable over links.

    ``print_of`` gives a set's fingerprint and ``propose`` pairs of nodes by them, which the sets decide as they do those by MinHash keys.

    Links join documents whose sets of shingles have a Jaccard similarity of ``least`` or more. Null texts and
    texts without words are one node. Rows with a null id have a component as others do, but never name
    it unless all ids in it are null. Other columns are ignored; an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "shingles")

    # A table that is written has a known size, so a join need not deal out the other side to a small one.
    marked = scratch.hold(_marked(docs, id_col, text_col, words_in_shingle, print_of))
    nodes = scratch.hold(marked.groupBy("node").agg(F.min("id").alias("least"), F.min("copy").alias("copy"), F.min("n").alias("n"), F.min("fp").alias("fp")))
    keys = marked.select("node", F.explode("keys").alias("key"))
    shared = scratch.put(keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("times")).where("low <> high").select("key", "times"))
    met = scratch.put(keys.join(apart(shared, "key"), "key").distinct())
    degree = met.groupBy("node").agg(F.sum("times").alias("degree"))
    ranked = scratch.put(met.select("key", "node").join(apart(degree, "node"), "node"))
    pivots = ranked.groupBy("key").agg(F.max(F.struct("degree", "node"))["node"].alias("pivot"))
    star = ranked.select("key", "node").join(apart(pivots, "key"), "key").where("node <> pivot")
    proposed, wanted = star.select(F.greatest("node", "pivot").alias("u"), F.least("node", "pivot").alias("v")), degree.select("node")
    if propose:
        # Different sets of one shingle have nothing in common.
        alike = propose(nodes.where("n > 1").select("node", "fp"), scratch)
        proposed = proposed.union(alike)
        wanted = wanted.union(alike.select("u")).union(alike.select("v"))
    first = scratch.put(proposed.distinct())
    copies = scratch.put(nodes.join(wanted, "node", "left_semi").select("copy"))
    sets = scratch.put(_sets(docs, text_col, copies, words_in_shingle))
    links = scratch.put(_verified(first, sets, least))
    roots = scratch.put(components(links, scratch))
    # What the stars left apart: nodes that share a key with one of another component.
    rooted = met.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    split = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    rest = scratch.put(rooted.join(apart(split, "key"), "key").select("node", "root").distinct())
    # Pairs of a star that failed may come again here; the sets decide as before.
    second = _unlinked(rest, sets, least, scratch)
    links = scratch.put(links.union(_verified(second, sets, least)))
    scratch.drop(sets, met, ranked, rest, first, second, shared, copies)
    roots = components(links, scratch)
    named = nodes.join(roots, nodes.node == roots.node, "left").select(nodes.node, "least", F.coalesce("root", nodes.node).alias("root"))
    out = named.join(apart(named.groupBy("root").agg(F.min("least").alias("component")), "root"), "root").select("node", "component")
    return marked.drop("keys").join(out, "node").select(F.col("id").alias(id_col), "node", "fp", "component")
