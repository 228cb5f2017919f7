"""The page pipeline as structured streams, and the batch steps that they share.

Messages are rows of files or of any source with the same schema. Routing is stateless. Stores are written in
``foreachBatch``: a batch is identified by its id, so a batch that runs again replaces its own output, and
delivery at least once ends in the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import html, scalars, scoring, urls
from ..sources.readers import raw_html

#: Messages a batch takes at most, by role.
MOST_POLLED = {"router": 100, "worker": 10, "storage": 50, "embedding": 32, "url_queue": 100}


def messages(spark: SparkSession, path: str, schema: T.StructType, role: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """A stream over a folder of Parquet files, from the earliest; bounded per trigger."""
    reader = spark.readStream.schema(schema)
    return reader.option("maxFilesPerTrigger", files_per_trigger or MOST_POLLED.get(role, 1000)).parquet(path)


def routed(pages: DataFrame, threshold: int = scoring.THRESHOLD) -> DataFrame:
    """Messages with score, route and reason; batch or stream."""
    return scoring.analyse(raw_html(pages), threshold=threshold)


def processed(pages: DataFrame) -> DataFrame:
    """Routed messages as results; the processor is the route."""
    return html.process(pages).withColumn("processor_type", F.col("route"))


def discovered(results: DataFrame) -> DataFrame:
    """One row per link of a success: (source_url, url, current_depth), normalised, in order, without repeats."""
    depth = F.col("current_depth") if "current_depth" in results.columns else F.lit(0)
    rows = results.where("success").select(F.col("url").alias("source_url"), (depth + 1).alias("current_depth"), urls.clean_all("extracted.links").alias("links"))
    return rows.select("source_url", "current_depth", F.posexplode("links").alias("position", "url"))


def fan_out(batch: DataFrame, sinks: dict[str, Callable[[DataFrame], DataFrame]], root: str, batch_id: int) -> None:
    """Writes what each sink selects from a batch; the batch is held once for all sinks."""
    batch.persist()
    try:
        for name, select in sinks.items():
            select(batch).write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")
    finally:
        batch.unpersist()


def start_router(pages: DataFrame, root: str, checkpoint: str, threshold: int = scoring.THRESHOLD, on_batch: Callable[[DataFrame, int], None] | None = None, **trigger):
    """raw pages to process.fast and process.rich; ``on_batch`` sees each routed batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if on_batch:
            on_batch(batch, batch_id)
        fan_out(batch, {"process.fast": lambda b: b.where("route = 'fast'"), "process.rich": lambda b: b.where("route = 'rich'")}, root, batch_id)

    return routed(pages, threshold).writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start()


def start_processor(pages: DataFrame, root: str, checkpoint: str, **trigger):
    """Routed pages to processed.final, processed.dlq and discovered.urls."""
    sinks = {"processed.final": lambda b: b.where("success"), "processed.dlq": lambda b: b.where("not success"), "discovered.urls": discovered}
    return processed(pages).writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda b, i: fan_out(b, sinks, root, i)).trigger(**(trigger or {"availableNow": True})).start()


def hourly_counters(results: DataFrame, time: str = "processed_at", late: str = "1 hour") -> DataFrame:
    """Tumbling hours: total, fast and rich; a watermark bounds the state."""
    g = results.withWatermark(time, late).groupBy(F.window(time, "1 hour"))
    return g.agg(F.count("*").alias("total_processed"), F.count_if(F.col("processor") == "fast").alias("fast_processed"), F.count_if(F.col("processor") == "rich").alias("rich_processed")).select(F.col("window.start").alias("stat_hour"), "total_processed", "fast_processed", "rich_processed")


_CAP_OUT = "key string, url string, outcome string"
_CAP_STATE = "n bigint"


def cap_per_key(rows: DataFrame, key: str, most: int, outcome: str = "domain_limit") -> DataFrame:
    """Streamed rows (url, arrival) with the outcome of a cap per key over the whole stream: (key, url, outcome).

    The first by arrival among all rows of a trigger are added, however many chunks a key's rows come in; kept
    are ``most`` rows and a chunk at a time. State is one counter per key. Exact repeats of a URL should be
    dropped before, by ``dropDuplicates``.
    """

    def count(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        first = None
        for pdf in batches:
            rows = pdf[["arrival", "url"]]
            rows = (rows if first is None else pd.concat([first, rows])).sort_values(["arrival", "url"])
            first, over = rows.iloc[: most - n], rows.iloc[most - n :]
            if len(over):
                yield pd.DataFrame({"key": k[0], "url": over["url"].to_numpy(), "outcome": outcome})
        if first is not None:
            n += len(first)
            if len(first):
                yield pd.DataFrame({"key": k[0], "url": first["url"].to_numpy(), "outcome": "added"})
        state.update((n,))

    return rows.groupBy(key).applyInPandasWithState(count, _CAP_OUT, _CAP_STATE, "append", GroupStateTimeout.NoTimeout)


def new_urls(rows: DataFrame, late: str | None = None, time: str = "seen_at") -> DataFrame:
    """Each URL once in a stream; with ``late`` the memory is bounded by a watermark."""
    rows = rows.withColumn("url_hash", scalars.url_hash("url"))
    return rows.dropDuplicates(["url_hash"]) if late is None else rows.withWatermark(time, late).dropDuplicatesWithinWatermark(["url_hash"])


class MergedTable:
    """A table that batches are merged into, kept as versions of hash buckets of its keys under a folder.

    A batch rewrites the buckets that it touches, under its own number; a bucket's state is its version of the
    highest number. So a batch that runs again starts from the same versions and replaces its own.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], buckets: int = 64):
        self.spark, self.root, self.schema, self.keys, self.buckets = spark, root.rstrip("/"), schema, keys, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def versions(self, before: int | None = None) -> dict[int, int]:
        """The last version of each bucket; ``before``: of lower batches only."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        last: dict[int, int] = {}
        for status in fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/bucket=*/batch=*")) or []:
            bucket, batch = (int(x.split("=")[1]) for x in status.getPath().toString().split("/")[-2:])
            if before is None or batch < before:
                last[bucket] = max(last.get(bucket, -1), batch)
        return last

    def read(self, buckets: set[int] | None = None, before: int | None = None) -> DataFrame:
        """The table as it stands, or the given buckets of it."""
        paths = [f"{self.root}/bucket={k}/batch={v}" for k, v in self.versions(before).items() if buckets is None or k in buckets]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def apply(self, batch: DataFrame, batch_id: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Merges a batch into the buckets that it touches."""
        touched = {r[0] for r in batch.select(self.bucket()).distinct().collect()}  # at most ``buckets``
        if touched:
            new = merge(self.read(touched, batch_id), batch).select(*self.schema.names).withColumn("bucket", self.bucket()).withColumn("batch", F.lit(batch_id))
            new.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(self.root)


def start_upsert(batches: DataFrame, table: MergedTable, merge: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str, may_run: Callable[[], bool] = lambda: True, **trigger):
    """A stream merged into a table: ``merge`` gives the next state of what a batch touches.

    ``may_run`` is asked before each batch; a refused batch is dropped, as under backpressure.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        if may_run():
            table.apply(batch, batch_id, merge)

    return batches.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply).trigger(**(trigger or {"availableNow": True})).start()


def retry_times(failures: DataFrame, now: float, most: int = 3, minutes: int = 30) -> DataFrame:
    """Failures that may be tried again, with the time they are due."""
    return failures.where((F.col("attempt") <= most) & scalars.recoverable("error_type")).withColumn("due", F.lit(float(now) + minutes * 60))
