"""Metric analytics in the manner of range queries over counters, gauges and histograms.

Samples are long rows (ts, name, labels..., value). Counter deltas come from ``lag`` within a series, a
reset counting from zero; a series is a bounded stretch of time per label set, so windows stay small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import ratio

#: Upper bounds of the histograms' buckets, in seconds.
LATENCY_BUCKETS = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0)
RESPONSE_BUCKETS = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0)


def instant(samples: DataFrame, labels: list[str]) -> DataFrame:
    """The latest value of each series."""
    return samples.groupBy("name", *labels).agg(F.max_by("value", "ts").alias("value"))


def counter_samples(results: DataFrame, minutes: int = 60) -> DataFrame:
    """Cumulative counters of completed and failed tasks, sampled every so many minutes."""
    g = results.groupBy(F.window("crawl_time", f"{minutes} minutes").end.alias("ts")).agg(F.count_if("success").alias("ok"), F.count_if(~F.col("success")).alias("bad"))
    long = g.select("ts", F.expr("stack(2, 'crawler_tasks_completed_total', ok, 'crawler_tasks_failed_total', bad) as (name, n)"))
    return long.select("ts", "name", F.sum("n").over(Window.partitionBy("name").orderBy("ts")).cast("double").alias("value"))


def increases(samples: DataFrame, labels: list[str]) -> DataFrame:
    """Rows (ts, labels, increase, seconds) between neighbouring samples of a counter."""
    w = Window.partitionBy("name", *labels).orderBy("ts")
    before = F.lag("value").over(w)
    delta = F.when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    return samples.select("name", *labels, "ts", delta.alias("increase"), (F.unix_timestamp("ts") - F.unix_timestamp(F.lag("ts").over(w))).alias("seconds")).where("increase is not null")


def rate(samples: DataFrame, labels: list[str], width: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """Increase per second in windows of ``width``."""
    g = increases(samples, labels).groupBy("name", *labels, F.window("ts", width, slide or width).alias("w")).agg(F.sum("increase").alias("i"), F.sum("seconds").alias("s"))
    return g.select("name", *labels, F.col("w.end").alias("ts"), F.round(ratio(F.col("i"), F.col("s")), 6).alias("rate"))


def sliding_rate(samples: DataFrame, labels: list[str], width: int = 300, slide: int = 60) -> DataFrame:
    """The rate per second of counters over the last ``width`` seconds at every multiple of ``slide`` seconds: (name, labels, ts, rate).

    A window is open at its start and closed at its end and needs two samples. A value below the one before is a reset: the counter went on from
    zero. The increase is extrapolated to both edges of the window where a sample lies within 1.1 mean gaps of it, else by half a gap, but never to
    before the counter was zero. A series has one sample at a time; null values or times are no samples.

    Samples meet their neighbours within panes of ``slide`` seconds, and panes theirs within a window, so no task holds a series.
    """
    if width % slide:
        raise ValueError("the width is no multiple of the slide")
    key = ["name", *labels]
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    s = samples.where("ts is not null and value is not null").select(*key, micros.alias("t"), F.col("value").cast("double").alias("v"))
    s = s.withColumn("pane", F.ceil(F.col("t") / F.lit(slide * 1_000_000)).cast("long"))
    before = F.lag("v").over(Window.partitionBy(*key, "pane").orderBy("t"))
    s = s.withColumn("lost", F.when(F.col("v") < before, before).otherwise(0.0))
    first, last = F.min(F.struct("t", "v")), F.max(F.struct("t", "v"))
    panes = s.groupBy(*key, "pane").agg(first.alias("first"), last.alias("last"), F.sum("lost").alias("lost"), F.count("*").alias("n"))
    each = panes.select(*key, F.explode(F.sequence(F.col("pane"), F.col("pane") + (width // slide - 1))).alias("end"), F.struct("first", "last", "lost", "n").alias("p"))
    w = each.groupBy(*key, "end").agg(F.array_sort(F.collect_list("p")).alias("p"))  # a struct a pane, in order of time
    gaps = F.zip_with(F.slice("p", 1, F.size("p") - 1), F.slice("p", 2, F.size("p") - 1), lambda a, b: F.when(b["first"]["v"] < a["last"]["v"], a["last"]["v"]).otherwise(0.0))
    total = F.aggregate(gaps, F.lit(0.0), lambda a, x: a + x) + F.aggregate("p", F.lit(0.0), lambda a, x: a + x["lost"])
    w = w.withColumns({"first": F.element_at("p", 1)["first"], "last": F.element_at("p", -1)["last"], "lost": total, "n": F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["n"])}).where("n >= 2")
    span = (F.col("last.t") - F.col("first.t")) / 1e6
    gap = span / (F.col("n") - 1)
    rise = F.col("last.v") - F.col("first.v") + F.col("lost")

    def reach(seconds: Column) -> Column:
        return F.when(seconds >= gap * 1.1, gap / 2).otherwise(seconds)

    end = F.col("end") * F.lit(slide)
    start = reach(F.col("first.t") / 1e6 - (end - width))
    zero = F.when((rise > 0) & (F.col("first.v") >= 0), span * F.col("first.v") / rise)
    whole = span + F.least(start, zero) + reach(end - F.col("last.t") / 1e6)
    return w.select(*key, F.timestamp_seconds(end).alias("ts"), (rise * whole / span / width).alias("rate"))


def matched_success_rate(samples: DataFrame, done: str, failed: str, width: int = 300, slide: int = 60) -> DataFrame:
    """100 * done / (done + failed) of sliding rates at the times that have both; null where neither rises."""
    r = sliding_rate(samples.where(F.col("name").isin(done, failed)), [], width, slide)
    g = r.groupBy("ts").agg(F.max(F.when(F.col("name") == done, F.col("rate"))).alias("a"), F.max(F.when(F.col("name") == failed, F.col("rate"))).alias("b"))
    return g.where("a is not null and b is not null").select("ts", ratio(F.col("a"), F.col("a") + F.col("b"), 100.0).alias("success_rate"))


def success_rate(samples: DataFrame, width: str) -> DataFrame:
    """Completed rate over completed and failed rate, in percent."""
    r = rate(samples, [], width).groupBy("ts").pivot("name", ["crawler_tasks_completed_total", "crawler_tasks_failed_total"]).agg(F.first("rate"))
    ok, bad = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("crawler_tasks_completed_total", "crawler_tasks_failed_total"))
    return r.select("ts", F.round(ratio(ok, ok + bad, 100.0), 4).alias("success_rate"))


def histogram(results: DataFrame, by: list[str], bounds=RESPONSE_BUCKETS, value: str = "response_time") -> DataFrame:
    """Cumulative buckets (by, le, n) of a histogram; le is infinite for the last."""
    edges = F.array(*[F.lit(float(b)) for b in bounds], F.lit(float("inf")))
    le = F.element_at(F.filter(edges, lambda b: F.col(value) <= b), 1)
    g = results.where(f"{value} is not null").groupBy(*by, le.alias("le")).agg(F.count("*").alias("m"))
    # Every series has every bucket, so that counts are cumulative: bounds are a fixed handful per series.
    full = g.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("le", "m"))).alias("have")).select(*by, "have", F.explode(edges).alias("le"))
    w = Window.partitionBy(*by).orderBy("le") if by else Window.partitionBy(F.lit(1)).orderBy("le")
    return full.select(*by, "le", F.sum(F.coalesce(F.element_at("have", F.col("le")), F.lit(0))).over(w).alias("n"))


def histogram_quantile(buckets: DataFrame, q: float, by: list[str]) -> DataFrame:
    """The quantile by linear interpolation in the bucket that holds it; the last bound for the open bucket."""
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    o = w.orderBy("le")
    b = buckets.withColumn("total", F.max("n").over(w)).withColumn("n0", F.coalesce(F.lag("n").over(o), F.lit(0))).withColumn("le0", F.coalesce(F.lag("le").over(o), F.lit(0.0)))
    rank = F.col("total") * q
    hit = b.where((F.col("n") >= rank) & (F.col("n0") < rank))
    inside = F.col("le0") + (F.col("le") - F.col("le0")) * (rank - F.col("n0")) / (F.col("n") - F.col("n0"))
    return hit.select(*by, F.round(F.when(F.col("le") == float("inf"), F.col("le0")).otherwise(inside), 6).alias("quantile"))


def latency_average(results: DataFrame, width: str) -> DataFrame:
    """Mean of a histogram's sum and count per window."""
    g = results.where("response_time is not null").groupBy(F.window("crawl_time", width).end.alias("ts")).agg(F.sum("response_time").alias("s"), F.count("*").alias("n"))
    return g.select("ts", F.round(ratio(F.col("s"), F.col("n")), 6).alias("latency_avg"))


def record_results(results: DataFrame) -> DataFrame:
    """The labelled counters that results update: (name, label, value)."""

    def counter(name: str, label: Column, where: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), label.cast("string").alias("label"), where.alias("on"))

    ok = F.col("success")
    each = F.array(
        counter("crawl_requests_total", F.when(ok, "success").otherwise("failed"), F.lit(True)),
        counter("crawl_errors_total", F.coalesce("error_type", F.lit("unknown")), ~ok),
        counter("crawl_http_status_total", F.col("status_code"), F.col("status_code").isNotNull()),
        counter("domain_failures_total", F.col("domain"), ~ok),
        counter("crawl_response_time_seconds_count", F.when(ok, "true").otherwise("false"), F.col("response_time").isNotNull()),
    )
    return results.select(F.explode(each).alias("c")).where("c.on").groupBy("c.name", "c.label").agg(F.count("*").alias("value"))


def sum_by(results: DataFrame, key: str) -> DataFrame:
    return results.groupBy(key).agg(F.count("*").alias("value"))


def topk_domains(results: DataFrame, n: int = 10) -> DataFrame:
    return results.where("not success").groupBy("domain").agg(F.count("*").alias("value")).orderBy(F.desc("value"), "domain").limit(n)


def errors_by_kind(results: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """One column per error type, in one pass."""
    return results.where("not success").agg(*(F.count_if(F.col("error_type") == k).alias(k) for k in kinds))


def domain_error_rate(results: DataFrame, n: int = 10) -> DataFrame:
    g = results.groupBy("domain").agg(F.round(ratio(F.count_if(~F.col("success")), F.count("*"), 100.0), 4).alias("error_rate"), F.count("*").alias("requests"))
    return g.orderBy(F.desc("error_rate"), F.desc("requests"), "domain").limit(n)


def range_summary(samples: DataFrame) -> DataFrame:
    """Latest, largest, smallest and mean value and the count of each metric; NaN is dropped."""
    return samples.where(~F.isnan("value")).groupBy("name").agg(F.max_by("value", "ts").alias("latest"), F.max("value").alias("max"), F.min("value").alias("min"), F.round(F.avg("value"), 6).alias("avg"), F.count("*").alias("count"))
