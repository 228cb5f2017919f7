"""Statistics of a run from the engine itself: metrics observed in a stream's plan, told by its progress, kept per batch and read as counters.

A stream observes its rows in passing (``observed``), so nothing is counted twice and no pass is added. A ``RunStatistics`` listener keeps what each batch
observed under the query's and the batch's number: a batch that runs again after a failure replaces its own numbers. ``samples`` turns them into
cumulative counters in the form that ``plans.metrics`` reads.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "ts timestamp, name string, n double, run string, batch long"


def observed(rows: DataFrame, name: str, metrics: dict[str, Column]) -> DataFrame:
    """The rows, whose aggregates ``metrics`` are told with each batch's progress under ``name``; aggregates are counts or sums."""
    return rows.observe(name, *[m.alias(k) for k, m in metrics.items()])


def result_metrics(success: str = "success", seconds: str = "response_time") -> dict[str, Column]:
    """What is counted of crawl results: processed, succeeded, failed, and the sum of their times."""
    ok = F.col(success)
    return {"processed_total": F.count(F.lit(1)), "succeeded_total": F.count_if(ok), "failed_total": F.count_if(~ok), "seconds_total": F.sum(seconds)}


class RunStatistics(StreamingQueryListener):
    """Keeps observed metrics under a folder, a handful of numbers per batch; ``done`` is set when a query has ended, after its last progress."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self.done = threading.Event()

    def onQueryStarted(self, event) -> None:
        self.done.clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        told = p.observedMetrics.get(self.name)
        if told is not None:
            rows = [(p.timestamp, k, float(v)) for k, v in told.asDict().items() if v is not None]
            frame = self.spark.createDataFrame(rows, "ts string, name string, n double").withColumn("ts", F.col("ts").cast("timestamp"))
            frame.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run={p.id}/batch={p.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.done.set()


def samples(spark: SparkSession, path: str) -> DataFrame:
    """Counters (ts, name, run, value) that each batch of each query has raised; a query goes on counting after a restart."""
    told = spark.read.schema(SCHEMA).option("basePath", path).parquet(path)
    return told.select("ts", "name", "run", F.sum("n").over(Window.partitionBy("run", "name").orderBy("batch")).alias("value"))
