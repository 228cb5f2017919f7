"""SimHash near-duplicates found through Golay-code fuzzy hashing.

A fingerprint of 64 bits has three segments of at most 22 bits, padded to words of the perfect
binary Golay code (23 bits, 12 of data, radius 3). Two fingerprints that differ in at most two bits
have a pair of segments with at most one differing bit between them (pigeonhole), so one segment of
that pair is equal and the other one bit away at most. Decoding a segment and its one-bit neighbours
gives its one to six nearby codeword indices; the index of a segment one bit away is among them. So
(equal segment, index) is a key that every linked pair shares, and a join on keys with a check of the
bits finds exactly the links.

Equal fingerprints are one node from the start. A key with very many fingerprints is refined by a
second, exact key: the 65 words within one bit of a fingerprint. Two at distance two or less share such
a word, and all that share one are within two bits, so a star of at most 65 replaces their pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import LOWER, Scratch, apart, arrow_map, components, merged, utf8

SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: (segment that is equal, segment that may differ in a bit)
COMBINATIONS = tuple((a, b) for a in range(3) for b in range(3) if a != b)
#: The code's generator, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0xAE3
#: Fingerprints under one key from which it is refined.
CROWDED = 48


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator."""
    rest = words.astype(np.uint32).copy()
    for bit in range(22, 10, -1):
        rest ^= (rest >> bit & 1) * np.uint32(GENERATOR << (bit - 11))
    return rest


def _error_table() -> np.ndarray:
    bits = 1 << np.arange(23, dtype=np.uint32)
    one = bits
    two = (one[:, None] ^ bits[None, :]).ravel()
    three = (two[:, None] ^ bits[None, :]).ravel()
    errors = np.unique(np.concatenate([[0], one, two, three]).astype(np.uint32))
    table = np.zeros(1 << 11, np.uint32)
    table[syndromes(errors)] = errors
    return table


ERRORS = _error_table()


def golay_index(words: np.ndarray) -> np.ndarray:
    """The 12 data bits of the codeword nearest to each 23-bit word."""
    return (words ^ ERRORS[syndromes(words)]) >> 11


def near_indices(words: np.ndarray) -> np.ndarray:
    """The indices of each word (first column) and of its 23 one-bit neighbours, as n x 24."""
    flips = np.concatenate([[0], 1 << np.arange(23)]).astype(np.uint32)
    return golay_index((words[:, None].astype(np.uint32) ^ flips).ravel()).reshape(-1, 24)


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, whether it is the row's own key) of all keys of the fingerprints."""
    segments = [(prints >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.uint32) for at, n in SEGMENTS]
    near = [near_indices(s).astype(np.int64) for s in segments]
    rows, keys, own = [], [], []
    for c, (a, b) in enumerate(COMBINATIONS):
        order = np.sort(near[b], axis=1)
        new = np.ones(order.shape, bool)
        new[:, 1:] = order[:, 1:] != order[:, :-1]
        row, col = np.nonzero(new)
        index = order[row, col]
        rows.append(row)
        keys.append(np.int64(c) << 40 | segments[a][row].astype(np.int64) << 12 | index)
        own.append(index == near[b][row, 0])
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(own)


def _bit_table() -> np.ndarray:
    return (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)


BITS = _bit_table()


def fingerprint(text: bytes, words_in_shingle: int, seed: int) -> int:
    """Bits set in over half the shingles' hashes; 0 without words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= words_in_shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends.tolist()]
    digest, k = xxhash.xxh64_intdigest, words_in_shingle
    hashes = [digest(joined[s:e], seed) for s, e in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=False)]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half the hashes; 0 of none."""
    octets = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, j], minlength=256) @ BITS for j in range(8)])
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = 3, seed: int = 42) -> DataFrame:
    """Rows (id, fp) with the fingerprint's bits as a signed long."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t, words_in_shingle, seed) for t in batch.column(1).to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["id", "fp"])

    return arrow_map(docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text")), run, f"id {docs.schema[id_col].dataType.simpleString()}, fp bigint")


def links_of(prints: DataFrame, scratch: Scratch, most_bits: int = 2) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) that connect all pairs within ``most_bits``."""
    if most_bits > 2:
        raise ValueError("three segments carry two differing bits at most")

    def expand(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = batch.column(0).to_numpy()
        row, key, own = keys_of(fp.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row]), pa.array(own)], ["key", "fp", "own"])

    keys = arrow_map(prints.select("fp"), expand, "key bigint, fp bigint, own boolean")
    # A key is of use only where several fingerprints meet and one has it as its own.
    shared = keys.groupBy("key").agg(F.count("*").alias("n"), F.max("own").alias("any")).where("n > 1 and any").select("key", "n")
    met = scratch.hold(keys.join(merged(apart(shared, "key")), "key"))
    light, heavy = met.where(F.col("n") <= CROWDED), met.where(F.col("n") > CROWDED)
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= most_bits
    paired = light.where("own").select("key", F.col("fp").alias("u")).join(merged(light.select("key", F.col("fp").alias("v"))), "key").where((F.col("u") != F.col("v")) & near)
    pairs = paired.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    crowded = heavy.select("fp").distinct()
    balls = crowded.select("fp", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("ball"))
    least = balls.groupBy("ball").agg(F.min("fp").alias("v"), F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    stars = least.select(F.explode("all").alias("u"), "v").where("u <> v").where(near)
    # Written, so that the keys can go.
    links = scratch.put(pairs.union(stars).distinct().repartition(max(8, int(scratch.spark.conf.get("spark.sql.shuffle.partitions")) // 8)))
    met.unpersist()
    return links


def near_nodes(nodes: DataFrame, scratch: Scratch, most_bits: int = 2) -> DataFrame:
    """Pairs (u, v), u > v, of nodes (node, fp) that connect all whose fingerprints are within ``most_bits``: each with the first of its fingerprint, and these by links."""
    firsts = scratch.put(nodes.groupBy("fp").agg(F.min("node").alias("first")))
    same = nodes.select("node", "fp").join(merged(apart(firsts, "fp")), "fp").where("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    links = links_of(firsts, scratch, most_bits)
    a, b = (firsts.select(F.col("fp").alias(c), F.col("first").alias(f"{c}_first")) for c in "uv")
    between = links.join(merged(a), "u").join(merged(b), "v").select(F.col("u_first").alias("u"), F.col("v_first").alias("v"))
    out = scratch.put(same.union(between).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    scratch.drop(firsts, links)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = 3, most_bits: int = 2, similarity: float | None = None) -> DataFrame:
    """One row per document: (id, fp, component), component the smallest id reachable over links.

    Links are fingerprints within ``most_bits``. With ``similarity`` those propose pairs of sets of shingles, a fingerprint
    being of the set, and the whole sets decide: a link is a Jaccard similarity of that or more. Two bits do not reach
    all pairs at 0.8, so that MinHash keys add the rest, see ``shingles``.
    Null texts and texts without words have fingerprint 0 and are linked like any other; shorter texts
    than a shingle hash whole. Rows with a null id have a component as others do, but never name it
    unless all ids in it are null. Other columns are ignored; an empty table gives an empty one.
    """
    if similarity is not None:
        found = shingles.near_duplicates(docs, id_col, text_col, words_in_shingle, similarity, majority, lambda nodes, scratch: near_nodes(nodes, scratch, most_bits))
        return found.select(id_col, "fp", "component")
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.hold(fingerprints(docs, id_col, text_col, words_in_shingle))
    nodes = scratch.hold(marked.groupBy("fp").agg(F.min("id").alias("least")))
    links = links_of(nodes, scratch, most_bits)
    roots = merged(components(links, scratch))
    scratch.drop(links)
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(merged(apart(rooted.groupBy("root").agg(F.min("least").alias("component")), "root")), "root").select("fp", "component")
    return marked.join(merged(named), "fp").select(F.col("id").alias(id_col), "fp", "component")
