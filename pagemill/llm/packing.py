"""Best-two-fit packing of tokenised documents into sequences of bounded length.

Documents of one length are interchangeable, so the packing is planned on the histogram of lengths,
which has at most ``capacity`` entries at any scale. A bin is filled greedily, longest first; then its
smallest document gives way to two unpacked ones that fill the widened gap more tightly. The same
bin is repeated while the counts allow, so the plan is a bounded list of patterns. Rows find their
place in it by their rank within their length, from counts per partition: no row is sorted or moved
by length, and one frequent length is no hot key.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, schema_of

#: Words whose ids a task keeps.
CACHE_WORDS = 200_000


class WordIds(dict):
    """Little-endian ids of a stretch of text, kept by stretch.

    The vocabulary's rule never joins a non-space with a following space, so a text falls apart
    before each single space between non-spaces, and each stretch is encoded on its own.
    """

    def __init__(self, ranks_path: str):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, stretch: str) -> bytes:
        ids = self.encode(stretch)
        out = pack(f"<{len(ids)}I", *ids)
        if len(stretch) < 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[stretch] = out
        return out


_words: dict[str, WordIds] = {}
_odd = re.compile(r"\s\s|^\s|\s$")
_gap = re.compile(r"(?<=\S) (?=\S)")


def ids_of(text: str, ranks_path: str) -> bytes:
    """The text's ids as little-endian unsigned 32-bit integers."""
    if not text:
        return b""
    words = _words.get(ranks_path)
    if words is None:
        words = _words[ranks_path] = WordIds(ranks_path)
    parts = _gap.split(text) if _odd.search(text) else text.split(" ")
    return b"".join([words[parts[0]], *map(words.__getitem__, map(" ".__add__, parts[1:]))])


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns ({length: how often in a bin}, bins) that use up all counts."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    while (there := np.flatnonzero(left)).size:
        free, bin_, gap = left.copy(), Counter(), capacity
        while gap and (fits := there[: np.searchsorted(there, gap, "right")]).size:
            length = int(fits[-1])
            n = int(min(gap // length, free[length]))
            bin_[length] += n
            free[length] -= n
            gap -= n * length
            if not free[length]:
                there = np.delete(there, np.searchsorted(there, length))
        if gap and sum(bin_.values()) > 1:
            least = min(bin_)
            a, b = best_two(free, gap + least)
            if a + b > least:
                bin_[least] -= 1
                bin_[a] += 1
                bin_[b] += 1
        bin_ = {k: n for k, n in bin_.items() if n}
        bins = int(min(left[k] // n for k, n in bin_.items()))
        for k, n in bin_.items():
            left[k] -= n * bins
        out.append((bin_, bins))
    return out


def best_two(free: np.ndarray, gap: int) -> tuple[int, int]:
    """The two free lengths of the largest sum within ``gap``; (0, 0) if none fit."""
    small = np.flatnonzero(free[: gap + 1])
    if not small.size:
        return 0, 0
    at = np.searchsorted(small, gap - small, "right") - 1
    other = np.where(at >= 0, small[np.maximum(at, 0)], 0)
    alone = (other == small) & (free[small] < 2)  # one document can't be both
    other = np.where(alone, np.where(at > 0, small[np.maximum(at - 1, 0)], 0), other)
    total = np.where(other > 0, small + other, 0)
    best = int(np.argmax(total))
    return (int(small[best]), int(other[best])) if total[best] else (0, 0)


def placements(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length << 44 | first rank, copies in a bin, first sequence, place in the bin), sorted."""
    used, first, rows = Counter(), 0, []
    for bin_, bins in plan:
        place = 0
        for length, n in sorted(bin_.items(), reverse=True):
            rows.append((length << 44 | used[length], n, first, place))
            used[length] += n * bins
            place += n * length
        first += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, ranks_path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places: (id, piece, start, length, ids_crc32, sequence_id, offset[, ids]).

    A document is its ids and then ``end_id``; only one longer than ``capacity`` is cut, from its end, so
    that just its first piece may be shorter. Null and empty texts are one piece of length 1. Null ids and
    repeated rows are packed row by row; other columns are ignored; an empty table gives an empty one.
    ``keep_ids`` adds each piece's ids as an array. Tokenised pieces are held on the executors' disks: what a
    lost executor held is tokenised again, with the same result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    ranks_path = ranks_path or default_ranks()
    id_type = docs.schema[id_col].dataType.simpleString()
    end = pack("<I", end_id)
    extra = ", ids array<bigint>" * keep_ids

    def cut(batches):
        seen, part = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for row, text in zip(range(batch.num_rows), batch.column(1).to_pylist(), strict=True):
                ids = ids_of(text, ranks_path) + end
                n = len(ids) // 4
                start, piece = 0, 0
                while start < n:
                    length = (n - start - 1) % capacity + 1 if not piece else capacity
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((row, piece, start, length, zlib.crc32(own), int(seen[length])) + ((np.frombuffer(own, "<u4").astype(np.int64),) if keep_ids else ()))
                    seen[length] += 1
                    start += length
                    piece += 1
            if rows:
                cols = list(zip(*rows, strict=True))
                arrays = [batch.column(0).take(pa.array(cols[0])), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:6])]
                arrays += [pa.array([part] * len(rows), pa.int32()), *([pa.array(cols[6], pa.list_(pa.int64()))] if keep_ids else [])]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "piece", "start", "length", "ids_crc32", "nth", "part", *["ids"] * keep_ids])

    pieces = scratch.hold(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(cut, schema_of(f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, nth bigint, part int{extra}")))
    by_part = scratch.hold(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = by_part.select("part", "length", before.alias("before"))
    counts = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    table = placements(plan_bins(counts, capacity))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
        row = table[np.searchsorted(table[:, 0], length << 44 | rank, "right") - 1]
        nth = rank - (row[:, 0] & ((1 << 44) - 1))
        arrays = [batch.column(k) for k in range(5)] + [pa.array(row[:, 2] + nth // row[:, 1]), pa.array(row[:, 3] + nth % row[:, 1] * length)]
        names = ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        if keep_ids:
            arrays.append(batch.column(batch.schema.get_field_index("ids")))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names)

    ranked = pieces.join(ranks.hint("merge"), ["part", "length"])  # the counts grow with the number of partitions
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"), *["ids"] * keep_ids)
    return arrow_map(ranked, place, f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint{extra}").withColumnRenamed("id", id_col)
