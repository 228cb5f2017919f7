"""Suffix-array dedup of byte strings that start twice anywhere in a corpus.

Suffixes are sorted by their leading tokens, only as far as a match of ``width`` bytes needs: first by
their 16 leading bytes, as two big-endian words, then by 64-bit names of the longer stretches that follow.
They are range-partitioned at splitters that Spark samples, in as many buckets as their number asks for;
each bucket is sorted by multikey quicksort, and equal neighbours repeat. Splitters reach into text and
place, so equal suffixes may fill several buckets; the ends of buckets are compared with each other.
Equal suffixes agree in 16 bytes and in two independent names, 128 bits; names alone decide nothing.

Sorting every suffix of a corpus would move many times its bytes, so suffixes stand for runs of them,
in three levels of the same sort. A row is (leading tokens, name, context): tokens and name are of bytes
that all the run's windows share, the context is of all bytes they cover. A name that occurs once settles
the run: nothing in it repeats. A context that occurs twice settles it too: all of it repeats. Only where
a name has several contexts, one run of each goes to the next level, as runs of a tenth of the length and
at last as single windows. The first level's runs are those of ``repeats``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, schema_of
from .repeats import RUN, TOKENS, Names, anchors, byte_values, covered, dealt_texts, keyed, leading_tokens, mix, run_lists, with_marks

PART, STEP = 100, 12
SMALL = 1 << 12
#: Suffixes of a bucket, about: what a task sorts in memory.
BUCKET_ROWS = 1 << 19
ROW = f"{TOKENS}, {RUN}"
ROW_NAMES = [f.split()[0] for f in ROW.split(", ")]
ORDER = ["token1", "token2", "name", "context", "rid", "at"]


def multikey_quicksort(keys: list[np.ndarray]) -> np.ndarray:
    """The order of rows by several token columns: three-way partitions on a column, equal rows go on to the next."""
    out = np.empty(len(keys[0]), np.int64)
    todo = [(np.arange(len(out)), 0, 0)]
    while todo:
        rows, place, depth = todo.pop()
        if depth == len(keys):
            out[place : place + len(rows)] = rows
            continue
        token = keys[depth][rows]
        if len(rows) <= SMALL:
            out[place : place + len(rows)] = rows[np.lexsort([*(k[rows] for k in keys[:depth:-1]), token])]
            continue
        sample = np.sort(token[:: len(token) // 63])
        pivot = sample[len(sample) // 2]
        less, same = token < pivot, token == pivot
        a, b = int(less.sum()), int(same.sum())
        todo += [(rows[less], place, depth), (rows[same], place + a, depth + 1), (rows[~(less | same)], place + a + b, depth)]
    return out


def settle(runs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Runs (rows of ``ROW``) that repeat whole, and one run of each context of names with several contexts.

    Both as written tables (id, rid, at, n, lead), so that what they come from can go. A context cut by a splitter
    may give one run for each bucket.
    """
    ddl = f"bucket int, edge tinyint, whole boolean, open boolean, {ROW}"
    names = [f.name for f in schema_of(ddl)]

    def bucket(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        keys = [t.column(c).to_numpy() for c in ORDER]
        order = multikey_quicksort(keys)
        first_name, first = np.ones(len(order), bool), np.ones(len(order), bool)
        first_name[1:] = False
        for k in keys[:3]:
            first_name[1:] |= k[order[1:]] != k[order[:-1]]
        first[1:] = first_name[1:] | (keys[3][order[1:]] != keys[3][order[:-1]])
        size = np.diff(np.append(np.flatnonzero(first), len(order)))
        whole = np.repeat(size > 1, size)
        group = np.cumsum(first_name) - 1
        several = np.bincount(group, weights=first)[group] > 1
        open_ = several & first
        edge = np.zeros(len(order), np.int8)
        edge[0] |= 1
        edge[-1] |= 2
        keep = whole | open_ | (edge > 0)
        # A bucket's last row may stand for its context, though it is not the first of it.
        open_[-1] |= several[-1]
        t = t.take(pa.array(order[keep])).combine_chunks()
        part = np.full(int(keep.sum()), TaskContext.get().partitionId(), np.int32)
        yield from pa.Table.from_arrays([pa.array(part), pa.array(edge[keep]), pa.array(whole[keep]), pa.array(open_[keep]), *(t.column(c) for c in names[4:])], names).to_batches()

    session = runs.sparkSession
    buckets = max(int(session.conf.get("spark.sql.shuffle.partitions")), runs.count() // BUCKET_ROWS)
    found = scratch.hold(runs.repartitionByRange(buckets, *ORDER).mapInArrow(bucket, schema_of(ddl)))
    edges = found.where("edge > 0").orderBy("bucket", "edge").collect()  # two rows a bucket at most
    mark = ["id", "rid", "at", "n", "lead"]
    whole, opened, spread = [], [], {}
    for a, b in zip(edges, edges[1:], strict=False):
        if a.bucket != b.bucket and all(a[k] == b[k] for k in ORDER[:4]):
            whole += [tuple(x[c] for c in mark) for x in (a, b) if not x.whole]
    for x in edges:
        spread.setdefault(tuple(x[k] for k in ORDER[:3]), []).append(x)
    for xs in spread.values():
        if len({x.bucket for x in xs}) > 1 and (any(x.open for x in xs) or len({x.context for x in xs}) > 1):
            opened += [tuple(x[c] for c in mark) for x in xs if not x.open]
    kind = schema_of("id bigint, rid bigint, at int, n int, lead int")

    files = max(4, int(session.conf.get("spark.sql.shuffle.partitions")) // 16)

    def written(flag: str, more: list[tuple]) -> DataFrame:
        df = found.where(flag).select(*mark)
        return scratch.put((df.union(session.createDataFrame(more, kind)) if more else df).repartition(files))

    out = written("whole", whole), written("open", opened)
    found.unpersist()
    return out


def finer(texts: DataFrame, width: int, step: int) -> DataFrame:
    """Runs of at most ``step`` windows, in place of the runs of texts (id, rid, z, runs of at, n, lead).

    Runs are counted from the anchor, so equal windows fall into like runs wherever a run begins.
    """

    def run(batches):
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            cols, size = [], 0
            for i, (starts, counts, leads) in enumerate(run_lists(batch.column(3), 3)):
                text = np.frombuffer(unpress.decompress(batch.column(2)[i].as_py()), np.uint8)
                names = Names(byte_values(text, None)[0])
                if step == 1:
                    at = np.unique(np.concatenate([np.arange(s, s + n) for s, n in zip(starts, counts, strict=True)]))
                    head = names.of(at, at + width // 2)
                    cols.append((*leading_tokens(text, at, width), head.view(np.int64), mix(head ^ names.of(at, at + width)).view(np.int64), np.full(len(at), i), at, np.ones(len(at), np.int64)))
                    size += len(at)
                else:
                    for s, n, lead in zip(starts, counts, leads, strict=True):
                        far = lead - np.arange(n)  # from a window to the anchor, falling
                        group = far // step
                        cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
                        m = np.diff(np.append(cut, n))
                        core = s + lead - group[cut] * step
                        a = s + cut
                        name = mix(names.of(core, core - step + 1 + width) + group[cut].astype(np.uint64))
                        context = mix(names.of(a, a + m - 1 + width) ^ mix((core - a).astype(np.uint64)))
                        cols.append((*leading_tokens(text, core, width - step + 1), name.view(np.int64), context.view(np.int64), np.full(len(a), i), a, m))
                        size += len(a)
                if cols and (size > 200_000 or i == batch.num_rows - 1):
                    token1, token2, name, context, row, at, n = (np.concatenate(x) for x in zip(*cols, strict=True))
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays([*map(pa.array, (token1, token2, name, context)), batch.column(0).take(take), batch.column(1).take(take), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(np.zeros(len(at), np.int32))], ROW_NAMES)
                    cols, size = [], 0

    return texts.mapInArrow(run, schema_of(ROW))


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 400, keep_bytes: bool = False) -> DataFrame:
    """Per row of ``docs``: (id, n_bytes, n_removed, n_spans, kept_sha256[, kept]).

    A byte goes if a string of ``width`` bytes that covers it also starts elsewhere in the table, in the
    same text or another; overlaps count, and strings are judged on the input. A null text counts as
    empty; texts shorter than ``width`` stay whole. A row repeated under one id is a text of its own, so
    both go. Null ids and other columns do no harm; an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    rows = keyed(docs, id_col, text_col)
    step = min(STEP, max(1, width // 8))
    part = min(PART, max(1, width // 2))
    first = scratch.put(anchors(rows, byte_values, width, part, tokens=True))
    whole, opened = settle(first, scratch)
    scratch.drop(first)
    texts, marks = dealt_texts(rows, scratch), whole
    for s in [step, 1] if step > 1 else [1]:
        runs = scratch.hold(finer(with_marks(texts, opened, "inner"), width, s))
        coarser = opened
        whole, opened = settle(runs, scratch)
        runs.unpersist()
        scratch.drop(coarser)
        marks = marks.union(whole)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        unpress, out = zstandard.ZstdDecompressor(), []
        for z, (starts, counts) in zip(batch.column(2).to_pylist(), run_lists(batch.column(3)), strict=True):
            text = unpress.decompress(z)
            n_removed = n_spans = 0
            kept = text
            if len(starts):
                gone = covered(starts, counts, width, len(text))
                n_removed, n_spans = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            out.append((len(text), n_removed, n_spans, hashlib.sha256(kept).hexdigest(), kept))
        cols = list(zip(*out, strict=True))
        arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3])]
        return pa.RecordBatch.from_arrays(arrays + [pa.array(cols[4], pa.binary())] * keep_bytes, ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_bytes)

    out = arrow_map(with_marks(texts, marks, "left"), cut, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * keep_bytes)
    return out.withColumnRenamed("id", id_col)
