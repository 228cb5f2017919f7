"""Benchmark decontamination by pigeonhole edit matching.

An item of m bytes (normalised) has an error budget of a share of m. Cut into budget-plus-one pieces,
one piece at least stands unharmed in any text that holds the item within the budget. Exact hits of
pieces come from names of stretches at every place of a text, looked up in a table of the pieces;
each hit proposes a place, where Myers' bit-parallel distance decides.

Texts are read once per block of items. Items fall into blocks by a hash, of half ``BLOCK_ITEM_BYTES`` on
average, so that what tasks hold and the driver sends does not grow with the benchmark; only a single item
longer than a block makes a longer one. Nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, flat_bytes, row_blocks, schema_of
from .repeats import BYTE_VALUES, Names

BLOCK_ITEM_BYTES = 8 << 20
BLOCK_BYTES = 1 << 20
#: Lengths of the stretches of pieces that are looked up.
STRETCHES = (16, 8, 4, 2, 1)
_punctuation = {c: " " for c in range(128) if not chr(c).isalnum()}


def normal(text: str | None) -> bytes:
    """Lower case, with every run of ASCII punctuation and white space as one space."""
    return " ".join(text.lower().translate(_punctuation).split()).encode("utf-8", "replace") if text else b""


def cut(item: bytes, budget: int) -> list[tuple[int, bytes]]:
    """(place, piece) of budget + 1 pieces of nearly equal length."""
    ends = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def myers(item: bytes, text: bytes) -> tuple[int, int]:
    """(least edit distance of the item to any stretch of the text, end of the first such stretch)."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    equal: dict[int, int] = {}
    for i, c in enumerate(item):
        equal[c] = equal.get(c, 0) | 1 << i
    plus, minus, score, best, at = full, 0, m, m, 0
    for j, c in enumerate(text, 1):
        eq = equal.get(c, 0)
        x = eq | minus
        d0 = (((eq & plus) + plus) ^ plus) | x
        hp = minus | ~(d0 | plus) & full
        hn = plus & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = hp << 1 & full, hn << 1 & full
        plus, minus = hn | ~(d0 | hp) & full, hp & d0
        if score < best:
            best, at = score, j
    return best, at


class Matcher:
    """A block of items with the table of their pieces."""

    def __init__(self, items: list[tuple[int, bytes]], error_rate: float):
        self.items = [(i, t, int(len(t) * error_rate)) for i, t in items]
        by: dict[int, list[tuple[bytes, int, int]]] = {}
        for n, (_, t, budget) in enumerate(self.items):
            for place, piece in cut(t, budget):
                q = next(q for q in STRETCHES if q <= len(piece))
                by.setdefault(q, []).append((piece[:q], n, place))
        self.tables = []
        for q, found in sorted(by.items()):
            values = BYTE_VALUES[np.frombuffer(b"".join(p for p, *_ in found), np.uint8)]
            starts = np.arange(len(found)) * q
            names = Names(values).raw(starts, starts + q)
            order = np.argsort(names, kind="stable")
            gate = np.zeros(1 << 20, bool)
            gate[names >> np.uint64(44)] = True
            self.tables.append((q, names[order], np.array([n for _, n, _ in found])[order], np.array([p for *_, p in found])[order], gate))

    def hits(self, flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(proposed starts, items) of piece hits at all places."""
        names, out = Names(BYTE_VALUES[flat]), []
        for q, table, item, place, gate in self.tables:
            m = len(flat) - q + 1
            if m <= 0:
                continue
            here = (names.sums[q : q + m] - names.sums[:m]) * names.back[:m]
            at = np.flatnonzero(gate[here >> np.uint64(44)])
            lo, hi = np.searchsorted(table, here[at], "left"), np.searchsorted(table, here[at], "right")
            n = hi - lo
            at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
            which = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            out.append((np.repeat(at, n) - place[which], item[which]))
        return out

    def search(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(row, item id, start, end, distance) of the best occurrence of each item in each text."""
        offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        flat = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        found = self.hits(flat)
        if not found:
            return []
        start, item = (np.concatenate(x) for x in zip(*found, strict=True))
        budget = np.array([b for *_, b in self.items])[item]
        # Proposals of one item a budget apart at most look at nearly the same stretch: one of them is enough.
        band = start // (2 * budget + 1)
        _, one = np.unique(np.stack([item, band]), axis=1, return_index=True)
        for s, n, b in zip(start[one].tolist(), item[one].tolist(), band[one].tolist(), strict=True):
            id_, t, k = self.items[n]
            first, last = b * (2 * k + 1), (b + 1) * (2 * k + 1)  # all starts of the band
            row = int(np.searchsorted(offsets, min(max(s + len(t) // 2, 0), len(flat) - 1), "right")) - 1
            for r in {row, int(np.searchsorted(offsets, min(max(s, 0), len(flat) - 1), "right")) - 1}:
                text, o = texts[r], int(offsets[r])
                lo = max(0, first - o - k)
                window = text[lo : max(0, last - o + len(t) + k)]
                exact = window.find(t)
                if exact >= 0:
                    got = (0, lo + exact, lo + exact + len(t))
                elif k and len(window) >= len(t) - k:
                    distance, end = myers(t, window)
                    if distance > k:
                        continue
                    _, back = myers(t[::-1], window[:end][::-1])
                    got = (distance, lo + end - back, lo + end)
                else:
                    continue
                if (r, id_) not in best or got < best[r, id_]:
                    best[r, id_] = got
        return [(r, i, a, b, d) for (r, i), (d, a, b) in sorted(best.items())]


def blocks_of(items: DataFrame, item_id: str, item_text: str):
    """The items (id, normalised text) in lists of bounded size, by a measured total."""
    items = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).cast("string").alias("t")).where("i is not null and t is not null").distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-int(total) // (BLOCK_ITEM_BYTES // 2))
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b).collect()
        found = [(r.i, t) for r in rows if (t := normal(r.t))]
        if found:
            yield sorted(found)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", error_rate: float = 0.05) -> DataFrame:
    """Rows (id, item_id, start, end, distance): which documents hold which items within the budget.

    The budget is ``error_rate`` of an item's normalised bytes; start and end are bytes of the normalised
    text, of the best occurrence (fewest errors, then first). Null and empty texts and items match
    nothing; an item id with two texts is matched by either; repeated rows are searched row by row, and
    null ids keep their rows. Other columns are ignored; an empty table gives an empty one.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    ddl = f"id {id_type}, item_id bigint, start bigint, end bigint, distance bigint"
    out = None
    for block in blocks_of(items, item_id, item_text):
        found = arrow_map(rows, _search(block, error_rate), ddl)
        out = found if out is None else out.union(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema_of(ddl))
    return out.withColumnRenamed("id", id_col)


def _search(block: list[tuple[int, bytes]], error_rate: float):
    held: list[Matcher] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if not held:
            held.append(Matcher(block, error_rate))
        _, offsets = flat_bytes(batch.column(1).fill_null("").cast(pa.binary()))
        found = []
        for a, b in row_blocks(offsets, BLOCK_BYTES):
            texts = [normal(t) for t in batch.column(1)[a:b].to_pylist()]
            found += [(r + a, *x) for r, *x in held[0].search(texts)]
        if not found:
            return None
        cols = list(zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0])), *(pa.array(c, pa.int64()) for c in cols[1:])], ["id", "item_id", "start", "end", "distance"])

    return run


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the rows that hold an item; all columns, clean rows and null ids with clean texts stay.

    The search runs where the row is: no join, and rows that share an id are judged one by one.
    """
    at = docs.columns.index(text_col)
    error_rate = how.get("error_rate", 0.05)
    for block in blocks_of(items, how.get("item_id", "item_id"), how.get("item_text", "text")):
        docs = arrow_map(docs, _clean(block, error_rate, at), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
    return docs


def _clean(block: list[tuple[int, bytes]], error_rate: float, at: int):
    search = _search(block, error_rate)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = search(pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows)), batch.column(at)], ["id", "text"]))
        keep = np.ones(batch.num_rows, bool)
        if found is not None:
            keep[found.column(0).to_numpy()] = False
        return batch.filter(pa.array(keep))

    return run
