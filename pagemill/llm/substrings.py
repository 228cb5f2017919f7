"""Substring dedup of word windows by level-wise doubling.

The first level looks at short sub-windows, the anchors of ``repeats``: windows whose anchor occurs in
one document alone end there. Those whose anchor repeats are extended to anchors of twice the length,
and so on up to the full width, until no candidates survive. At each level a run of windows whose whole
context repeats is settled at once, whatever the number of its copies; only one run of each context of
a name with several goes on. Of equal windows those in the document with the smallest id stay.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, apart, arrow_map
from .repeats import anchors, covered, dealt_texts, extended, keyed, opened, run_lists, with_marks, word_values

#: The first level's sub-windows have at most so many words.
SHORTEST = 13
MARK = ["id", "rid", "at", "n", "lead"]


def levels(width: int) -> list[int]:
    """Lengths that double up to ``width``."""
    out = [width]
    while len(out) == 1 or out[0] > SHORTEST:
        out.insert(0, -(-out[0] // 2))
    return out


def survivors(found: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(runs that repeat whole, runs to extend, the table of both) of one level's anchors.

    Names under one id only are gone. Of a context all runs in its first document go on where the name has
    other contexts: each may repeat an earlier one in part.
    """
    found = scratch.put(found)
    again = found.groupBy("name").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("name")
    # Few rows are left: dealt out anew they make few files, and the joins keep their tasks.
    files = max(8, int(scratch.spark.conf.get("spark.sql.shuffle.partitions")) // 8)
    met = scratch.put(found.join(apart(again, "name"), "name").repartition(files))
    contexts = met.groupBy("name", "context").agg(F.min("id").alias("first_id"), F.max("id").alias("last"))
    mixed = contexts.groupBy("name").agg((F.min("context") < F.max("context")).alias("mixed"))
    contexts = contexts.join(apart(mixed, "name"), "name").where("last > first_id or mixed")
    kept = scratch.put(met.join(apart(contexts, "name", "context"), ["name", "context"]).select(*MARK, "first_id", "mixed").repartition(files))
    scratch.drop(found, met)
    return kept.where("id > first_id").select(*MARK), kept.where("mixed and id = first_id").select(*MARK), kept


def remove_repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, keep_text: bool = False) -> DataFrame:
    """Per row of ``docs``: (id, n_words, n_removed, kept_sha256[, kept]).

    Words are runs of bytes other than space and 09-0D. A word goes if a window of ``width`` words that
    covers it also starts in a row with a smaller id; windows are judged on the input. A null or blank
    text has no words. Rows that repeat an id don't remove each other's words; rows with a null id keep
    theirs and remove none. Other columns do no harm; an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "substrings")
    rows = keyed(docs, id_col, text_col)
    lengths = levels(width)
    found, texts, gone, done = anchors(rows.where("id is not null"), word_values, width, lengths[0]), None, [], []
    for longer in lengths[1:]:
        whole, on, kept = survivors(found, scratch)
        gone.append(whole)
        done.append(kept)
        if texts is None:
            texts = dealt_texts(rows, scratch)
        if on.isEmpty():
            break
        found = extended(texts, on, word_values, width, longer) if longer < width else None
    else:
        windows = opened(texts, on, word_values, width)  # read twice, named anew rather than kept
        first = windows.groupBy("t1", "t2").agg(F.min("id").alias("first_id"), F.max("id").alias("last")).where("last > first_id").drop("last")
        gone.append(windows.join(apart(first, "t1", "t2"), ["t1", "t2"]).where("id > first_id").select("id", "rid", "at", F.lit(1).alias("n"), F.lit(0).alias("lead")))
    marks = scratch.put(reduce(DataFrame.union, gone))
    scratch.drop(*done)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        unpress, out = zstandard.ZstdDecompressor(), []
        for z, (starts, counts) in zip(batch.column(2).to_pylist(), run_lists(batch.column(3)), strict=True):
            words = unpress.decompress(z).split()
            n, kept = len(words), words
            if len(starts):
                gone = covered(starts, counts, width, n)
                kept = [words[i] for i in np.flatnonzero(~gone)]
            text = b" ".join(kept)
            out.append((n, n - len(kept), hashlib.sha256(text).hexdigest(), text))
        cols = list(zip(*out, strict=True))
        arrays = [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2])]
        return pa.RecordBatch.from_arrays(arrays + [pa.array(cols[3], pa.binary())] * keep_text, ["id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * keep_text)

    out = arrow_map(with_marks(texts, marks, "left"), cut, "id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept binary" * keep_text)
    if keep_text:
        out = out.withColumn("kept", F.col("kept").cast("string"))
    return out.withColumnRenamed("id", id_col)
