"""What several operators of this subpackage share: scratch tables, Arrow plumbing, link components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where none is set, a temporary folder stands in for it if the session runs in this process alone;
    executors of a cluster would not see it, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="pagemill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: A translation of bytes that lower-cases A-Z.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Rows of a scratch file, where their number is known before.
FILE_ROWS = 500_000


class Scratch:
    """Tables written under the shared folder: they cut lineage and survive lost executors.

    ``put`` writes a frame and reads it back with the same schema; ``drop`` removes one
    that no later step reads, so that disk use stays near one generation of tables.
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.base, self.n = spark, f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}", 0

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def put(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """Writes and reads back; about ``rows`` rows, where that is known, make few files."""
        if rows is not None:
            df = df.coalesce(1 + rows // FILE_ROWS)
        self.n += 1
        path = self.path(f"t{self.n}")
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def hold(self, df: DataFrame) -> DataFrame:
        """Keeps a frame that several steps read on the executors' disks; lost parts are computed again."""
        return df.persist(StorageLevel.DISK_ONLY)

    def release(self) -> None:
        """Lets the session notice which frames are gone: only then do the files of their shuffles go."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark._jvm
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def schema_of(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


#: Spark's limit on the bytes of an Arrow batch (64 MB unless set), and what holds here. A task has several copies of a batch, in the executor and in its Python worker.
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of about ``BATCH_BYTES`` from now on, in a session that sets no limit of its own."""
    if BATCH_LIMIT not in spark.conf.getAll:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


def give_back() -> None:
    """Returns freed memory to the system: a Python worker runs many tasks, and would keep what the largest has taken."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], ddl: str) -> DataFrame:
    """``mapInArrow`` of a function on single batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = out = None
        try:
            for batch in batches:
                if batch.num_rows and (out := fn(batch)) is not None and out.num_rows:
                    yield out
        finally:
            batch = out = None
            give_back()

    return df.mapInArrow(run, schema_of(ddl))


def apart(grouped: DataFrame, *keys: str) -> DataFrame:
    """Long keys of a grouped frame written anew, so that a join deals it out again beside the other side.

    Joined as it stands, a group would share its stage with the join, and Spark could not split a hot key.
    """
    return grouped.withColumns({k: F.col(k).bitwiseXOR(F.lit(0).cast("long")) for k in keys})


def merged(side: DataFrame) -> DataFrame:
    """A side of a join that is dealt out, sorted and merged: adaptive execution would send a table of up to 10 MB through the driver, where it takes many times that."""
    return side.hint("merge")


def sampled(share: float, *columns: str) -> F.Column:
    """Whether a row falls into a sample of that share, by a hash of columns; shares may be as small as 1e-15."""
    return F.lit(True) if share >= 1 else F.xxhash64(*columns).bitwiseAND(F.lit((1 << 63) - 1)) < F.lit(int(share * (1 << 63)))


def utf8(text) -> F.Column:
    """UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column end to end, and the offsets of its rows (no nulls expected)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes; a longer row stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, min(last, rows)
        first = last


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of links (u, v) as rows (node, root), root the smallest node reachable.

    Alternating large-star and small-star steps: each is a grouped minimum, pre-aggregated before
    its shuffle, and an equi-join that adaptive execution may split at a hot node. Every
    generation is a scratch table, and the loop ends when a generation repeats.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        if large:
            pairs = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        joined = pairs.join(merged(apart(least, "u")), "u")
        if large:
            return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.where("m < u").select("u", F.col("m").alias("v"))
        return joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(own)

    down = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = scratch.put(down)
    mark: tuple | None = None
    while True:
        big = star(now, True).where("u <> v").distinct()
        step = star(big, False).where("u <> v").distinct()
        then = scratch.put(step, mark and mark[0])
        found = then.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(now)
        now = then
        if tuple(found) == mark or not found[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(found)
