"""Repeated windows of texts: what suffix-array dedup (bytes) and substring dedup (words) share.

A window is ``width`` consecutive tokens of one text. Among the sub-windows of ``part`` tokens that a
window holds it picks the one with the least hash, its anchor; equal windows pick equal anchors, and
neighbouring windows mostly share theirs, so a text has few anchors. An anchor with the run of windows
that pick it is one small row: (name of the sub-window, name of the run's whole context, text, place).

* An anchor whose name occurs once settles all its windows: none repeats.
* Anchors with the same context settle all windows of the run at once, whatever their number.
* Where a name has several contexts, one run of each context is opened: its windows go on to longer
  anchors or are compared one by one, named in full by 128 bits. Copies that differ in places open
  only the runs at those places.

Row keys are (id, hash of id and text), so that repeated ids do no harm.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, flat_bytes, row_blocks, schema_of, utf8

BLOCK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))


def powers(of: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(of))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 20), of, np.uint64)
        have[0] = 1
        have = _powers[int(of)] = np.multiply.accumulate(have)
    return have[:n]


class Names:
    """Names (hashes) of any stretch of a sequence of 64-bit values, from running sums."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(values * powers(BASE, self.n), out=self.sums[1:])
        self.back = powers(INVERSE, self.n + 1)

    def raw(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return (self.sums[last] - self.sums[first]) * self.back[first]

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mix(self.raw(first, last) + (last - first).astype(np.uint64))

    def every(self, length: int) -> np.ndarray:
        """Of the stretch of that length at each place."""
        m = max(0, self.n - length + 1)
        return mix((self.sums[length : length + m] - self.sums[:m]) * self.back[:m] + np.uint64(length))


def sliding_least(values: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` neighbours."""
    n = len(values)
    rows = -(-n // span)
    grid = np.full(rows * span, np.uint64(0xFFFFFFFFFFFFFFFF))
    grid[:n] = values
    grid = grid.reshape(rows, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - span + 1], ahead[span - 1 : n])


def anchor_runs(values: np.ndarray, offsets: np.ndarray, width: int, part: int, alive: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor's name, context's name, anchor's place from the first window) of all runs.

    ``alive``: which windows count, all if it is not given.
    """
    none = np.zeros(0, np.int64)
    if len(values) < width:
        return none, none, none, none, none, none
    names, span = Names(values), width - part + 1
    low = np.uint64((1 << 24) - 1)
    if len(values) > int(low):
        raise ValueError("a block is too long")
    sub = names.every(part)
    least = sliding_least((sub & ~low) | np.arange(len(sub), dtype=np.uint64), span)
    at = (least & low).astype(np.int64)
    text = np.searchsorted(offsets, np.arange(len(at)), "right") - 1
    fits = np.arange(len(at)) + width <= offsets[text + 1]
    if alive is not None:
        fits &= alive
    new = fits.copy()
    new[1:] &= ~fits[:-1] | (at[1:] != at[:-1])
    first = np.flatnonzero(new)
    end = fits.copy()
    end[:-1] &= ~fits[1:] | (at[1:] != at[:-1])
    last = np.flatnonzero(end)
    anchor = at[first]
    context = mix(names.of(first, last + width) ^ mix((anchor - first).astype(np.uint64)))
    return text[first], first - offsets[text[first]], last - first + 1, sub[anchor].view(np.int64), context.view(np.int64), anchor - first


def byte_values(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_VALUES[flat], offsets


_space = np.zeros(256, bool)
_space[[9, 10, 11, 12, 13, 32]] = True


def word_bounds(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in the bytes, and the number of the first word of each text."""
    inside = ~_space[flat]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(flat))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(first, offsets)


def word_values(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    first, last, texts = word_bounds(flat, offsets)
    return Names(BYTE_VALUES[flat]).of(first, last), texts


Values = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, rid, text as bytes): rid tells rows with one id apart by their text."""
    id_, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(id_.alias("id"), F.xxhash64(id_, text).alias("rid"), utf8(text_col).alias("text"))


def pieces(values: np.ndarray, offsets: np.ndarray, width: int, most: int):
    """(values, offsets, texts, shift) of a block: as it is, or one long text in overlapping pieces."""
    if len(values) <= most + width:
        yield values, offsets, 0
        return
    for start in range(0, len(values) - width + 1, most):
        own = values[start : start + most + width - 1]
        yield own, np.array([0, len(own)]), start


#: Rows of runs of windows, see ``anchors``.
RUN = "name bigint, context bigint, id bigint, rid bigint, at int, n int, lead int"
TOKENS = "token1 bigint, token2 bigint"


def leading_tokens(flat: np.ndarray, at: np.ndarray, most: int) -> list[np.ndarray]:
    """The first 16 bytes, or ``most``, at each place as two big-endian words whose signed order is that of the bytes."""
    k = min(16, most)
    head = np.zeros((len(at), 16), np.uint8)
    head[:, :k] = flat[at[:, None] + np.arange(k)]
    return [(w.astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64) for w in head.view(">u8").T]


def anchors(rows: DataFrame, of: Values, width: int, part: int, tokens: bool = False) -> DataFrame:
    """Rows (name, context, id, rid, at, n, lead) of all anchors; ``tokens``, for bytes: the anchors' leading ones before."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, offsets = flat_bytes(batch.column(2))
        found = []
        for a, b in row_blocks(offsets, BLOCK_BYTES):
            block, places = flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            values, seq = of(block, places)
            for own, bounds, shift in pieces(values, seq, width, 8 * BLOCK_BYTES):
                text, at, n, name, context, lead = anchor_runs(own, bounds, width, part)
                found.append((text + a, at + shift, n, name, context, lead, *(leading_tokens(block, places[text] + shift + at + lead, part) if tokens else ())))
        text, at, n, name, context, lead, *first = (np.concatenate(x) for x in zip(*found, strict=True))
        take = pa.array(text)
        arrays = [*map(pa.array, first), pa.array(name), pa.array(context), batch.column(0).take(take), batch.column(1).take(take), *(pa.array(x.astype(np.int32)) for x in (at, n, lead))]
        return pa.RecordBatch.from_arrays(arrays, [*["token1", "token2"] * tokens, "name", "context", "id", "rid", "at", "n", "lead"])

    return arrow_map(rows, run, f"{TOKENS}, {RUN}" if tokens else RUN)


def squeezed(rows: DataFrame) -> DataFrame:
    """(id, rid, z): texts compressed for their way through a shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        press = zstandard.ZstdCompressor(level=4).compress
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([press(x) for x in batch.column(2).to_pylist()], pa.binary())], ["id", "rid", "z"])

    return arrow_map(rows, run, "id bigint, rid bigint, z binary")


def by_text(marks: DataFrame) -> DataFrame:
    """(id, rid, runs): the marks (at, n, lead) of one text together, at most as many as it has tokens."""
    return marks.groupBy("id", "rid").agg(F.collect_list(F.struct("at", "n", "lead")).alias("runs"))


def dealt_texts(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, rid, z) held in the order in which ``with_marks`` joins: only marks are shuffled from then on."""
    keys = ["rid", F.coalesce("id", F.lit(0).cast("long")), F.isnull("id")]  # as Spark itself writes a null-safe key
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return scratch.hold(squeezed(rows).repartition(n, *keys).sortWithinPartitions(*keys))


def with_marks(texts: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """Dealt texts joined with their marks: (id, rid, z, runs)."""
    a, b = texts.alias("a"), by_text(marks).hint("merge").alias("b")
    return a.join(b, (F.col("a.rid") == F.col("b.rid")) & F.col("a.id").eqNullSafe(F.col("b.id")), how).select("a.id", "a.rid", "a.z", "b.runs")


def run_lists(column: pa.Array, fields: int = 2) -> list[tuple[np.ndarray, ...]]:
    """(starts, counts[, leads]) of each row's runs."""
    out, empty = [], np.zeros(0, np.int64)
    for row in column:
        if not row.is_valid or not len(row.values):
            out.append((empty,) * fields)
        else:
            v = row.values
            out.append(tuple(v.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(fields)))
    return out


def alive_windows(starts: np.ndarray, counts: np.ndarray, windows: int) -> np.ndarray:
    """Which windows the runs hold."""
    change = np.zeros(windows + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + counts, -1)
    return np.cumsum(change[:-1]) > 0


def per_text(texts: DataFrame, marks: DataFrame, of: Values, fn: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, ...]], ddl: str) -> DataFrame:
    """Rows (id, rid, *columns) that ``fn(values, starts, counts)`` gives as columns for each marked text."""
    names = [f.name for f in schema_of(ddl)]

    def run(batches):
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            cols, size = [], 0
            for i, (starts, counts) in enumerate(run_lists(batch.column(3))):
                text = np.frombuffer(unpress.decompress(batch.column(2)[i].as_py()), np.uint8)
                found = fn(of(text, np.array([0, len(text)]))[0], starts, counts)
                cols.append((np.full(len(found[0]), i), *found))
                size += len(found[0])
                if size > 200_000 or i == batch.num_rows - 1:
                    row, *rest = (np.concatenate(x) for x in zip(*cols, strict=True))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), *map(pa.array, rest)], names)
                    cols, size = [], 0

    return with_marks(texts, marks, "inner").mapInArrow(run, schema_of(ddl))


def extended(texts: DataFrame, marks: DataFrame, of: Values, width: int, part: int) -> DataFrame:
    """Anchors of ``part`` tokens of the windows in the marked runs, as rows (id, rid, name, context, at, n, lead)."""

    def longer(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        alive, found = alive_windows(starts, counts, len(values) - width + 1), []
        for own, bounds, shift in pieces(values, np.array([0, len(values)]), width, 8 * BLOCK_BYTES):
            here = np.zeros(len(own) - part + 1 - (width - part), bool)
            here[:] = alive[shift : shift + len(here)]
            _, at, n, name, context, lead = anchor_runs(own, bounds, width, part, here)
            found.append((name, context, *(x.astype(np.int32) for x in (at + shift, n, lead))))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    return per_text(texts, marks, of, longer, "id bigint, rid bigint, name bigint, context bigint, at int, n int, lead int")


def opened(texts: DataFrame, marks: DataFrame, of: Values, width: int) -> DataFrame:
    """Rows (id, rid, t1, t2, at) of all windows of the marked runs; t1 and t2 name a window's halves."""
    half = width // 2

    def single(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        at, names = np.flatnonzero(alive_windows(starts, counts, len(values) - width + 1)), Names(values)
        return names.of(at, at + half).view(np.int64), names.of(at + half, at + width).view(np.int64), at.astype(np.int32)

    return per_text(texts, marks, of, single, "id bigint, rid bigint, t1 bigint, t2 bigint, at int")


def covered(starts: np.ndarray, counts: np.ndarray, width: int, tokens: int) -> np.ndarray:
    """Which tokens the windows of the runs cover."""
    change = np.zeros(tokens + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + counts - 1 + width, -1)
    return np.cumsum(change[:-1]) > 0
