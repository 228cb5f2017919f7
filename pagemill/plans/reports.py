"""Operational reports over crawl results, stored pages and chunks.

Each report is a plan over a frame of the table it reads; relative windows take ``as_of``. Every grouped
aggregate is pre-aggregated before its one shuffle; totals for percentages come from the groups already
made, so a table is read once. Lists with a limit end in a top-k, with a key that breaks ties.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import percent, ratio


def ok() -> Column:
    return F.col("success")


def _n(flag: Column) -> Column:
    return F.count_if(flag)


def _sum(flag: Column) -> Column:
    """Rows that hold, null where there is no row at all."""
    return F.sum(F.when(flag, 1).otherwise(0))


def _avg(c: str = "response_time") -> Column:
    return F.round(F.avg(c), 2)


def recent(df: DataFrame, as_of: str, interval: str, time: str = "crawl_time") -> DataFrame:
    """Rows later than ``as_of`` minus an interval such as ``6 HOURS``."""
    return df.where(F.col(time) > F.expr(f"timestamp '{as_of}' - interval {interval}"))


def _share(df: DataFrame, key: str, n: str = "count") -> DataFrame:
    """Adds each group's percentage of all groups; the groups are few."""
    return df.withColumn("percentage", percent(F.col(n), F.sum(n).over(Window.partitionBy(F.lit(1)))))


def error_stats(results: DataFrame) -> DataFrame:
    """Failures by error type, as a share of all failures, with and without a type."""
    g = results.where(~ok()).groupBy("error_type").agg(F.count("*").alias("count"), _avg().alias("avg_response_time"), F.round(F.max("response_time"), 2).alias("max_response_time"), F.min("crawl_time").alias("first_seen"), F.max("crawl_time").alias("last_seen"))
    return _share(g, "error_type").where("error_type is not null").orderBy(F.desc("count"), "error_type")


def domain_failure_stats(results: DataFrame, least: int = 3) -> DataFrame:
    g = results.groupBy("domain").agg(F.count("*").alias("total_attempts"), _n(ok()).alias("successes"), _n(~ok()).alias("failures"), _avg().alias("avg_response_time"), F.array_join(F.sort_array(F.collect_set("error_type")), ",").alias("error_types")).where(F.col("total_attempts") >= least)
    return g.withColumn("failure_rate", percent(F.col("failures"), F.col("total_attempts")))


def hourly_success(results: DataFrame) -> DataFrame:
    g = results.groupBy(F.date_trunc("hour", "crawl_time").alias("hour")).agg(F.count("*").alias("total"), _n(ok()).alias("successes"), _n(~ok()).alias("failures"), _avg().alias("avg_response_time"))
    return g.withColumn("success_rate", percent(F.col("successes"), F.col("total")))


def quantiles(df: DataFrame, key: str, value: str, shares: dict[str, float], totals: dict[str, Column] | None = None) -> DataFrame:
    """(key, one column a share): exact, interpolated quantiles of a group's values, nulls left out; ``totals`` are sums, by name, of the same groups.

    A first pass counts the values in narrow bins, together with all totals: running sums over the bins of a group find the bins that hold the
    wanted ranks. A second pass counts and orders the values of these bins alone, so neither a shuffle nor a task holds a group's values, whatever
    the number of groups. Keys are not null. Groups without values have their totals, and null quantiles.
    """
    x, totals = F.col(value), totals or {}
    bin_ = F.floor(F.signum(x) * F.log1p(F.abs(x)) * 1000)
    binned = df.groupBy(key, bin_.alias("_bin")).agg(F.count(x).alias("_m"), *[F.sum(c).alias(name) for name, c in totals.items()])
    one, upto = Window.partitionBy(key), Window.partitionBy(key).orderBy("_bin")
    ranks = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), (F.floor if side == "low" else F.ceil)(F.lit(q) * (F.col("_total") - 1)).alias("rank")) for name, q in shares.items() for side in ("low", "high")])
    bins = binned.where("_bin is not null").withColumn("_total", F.sum("_m").over(one)).withColumn("_before", F.sum("_m").over(upto) - F.col("_m")).withColumn("_want", F.explode(ranks))
    wanted = bins.where((F.col("_want.rank") >= F.col("_before")) & (F.col("_want.rank") < F.col("_before") + F.col("_m"))).select(key, "_bin", "_before", "_total", "_want.*")
    # A bin's wanted ranks are one row, so that no value is copied by the join.
    held = wanted.groupBy(key, "_bin").agg(F.collect_list(F.struct("_before", "_total", "name", "side", "rank")).alias("_want"))
    met = df.where(x.isNotNull()).select(key, x.cast("double").alias("_x"), bin_.alias("_bin")).join(held.select(key, "_bin"), [key, "_bin"], "left_semi")
    counted = met.groupBy(key, "_bin", "_x").agg(F.count("*").alias("_n"))
    few = counted.join(held, [key, "_bin"]).withColumn("_in", F.sum("_n").over(Window.partitionBy(key, "_bin").orderBy("_x"))).select(key, "_x", "_n", "_in", F.explode("_want").alias("_w")).select(key, "_x", "_n", "_w.*", (F.col("_in") + F.col("_w._before")).alias("_upto"))
    hit = few.where((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("_n")))

    def at(name: str, q: float) -> Column:
        low, high = (F.max(F.when((F.col("name") == name) & (F.col("side") == side), F.col("_x"))) for side in ("low", "high"))
        part = F.lit(q) * (F.max("_total") - 1)
        return (low + (high - low) * (part - F.floor(part))).alias(name)

    found = hit.groupBy(key).agg(*[at(name, q) for name, q in shares.items()])
    return binned.groupBy(key).agg(*[F.sum(name).alias(name) for name in totals]).join(found, key, "left") if totals else found


def worker_performance(results: DataFrame) -> DataFrame:
    totals = {"total_requests": F.lit(1), "successes": ok().cast("int"), "failures": (~ok()).cast("int"), "_time": F.col("response_time"), "_timed": F.col("response_time").isNotNull().cast("int")}
    g = quantiles(results.where("worker_id is not null"), "worker_id", "response_time", {"p95_response_time": 0.95}, totals)
    g = g.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("successes", "failures")})
    g = g.withColumns({"success_rate": percent(F.col("successes"), F.col("total_requests")), "avg_response_time": F.round(F.try_divide("_time", "_timed"), 2), "p95_response_time": F.round("p95_response_time", 2)})
    return g.select("worker_id", "total_requests", "successes", "failures", "avg_response_time", "p95_response_time", "success_rate")


def recent_error_stats(results: DataFrame, as_of: str, minutes: int = 60) -> DataFrame:
    g = recent(results, as_of, f"{minutes} MINUTES").where(~ok() & F.col("error_type").isNotNull()).groupBy("error_type").agg(F.count("*").alias("count"), _avg().alias("avg_response_time"))
    return _share(g, "error_type")


def domain_status(results: DataFrame, domain: str) -> DataFrame:
    """One row about one domain; no attempts and nulls if it was never tried."""
    g = results.where(F.col("domain") == domain).agg(F.count("*").alias("total_attempts"), _sum(ok()).alias("successes"), _sum(~ok()).alias("failures"), F.max(F.when(ok(), F.col("crawl_time"))).alias("last_success"), F.max(F.when(~ok(), F.col("crawl_time"))).alias("last_failure"), F.array_join(F.sort_array(F.collect_set("error_type")), ",").alias("common_errors"))
    return g.withColumn("failure_rate", percent(F.col("failures"), F.col("total_attempts")))


def overall(results: DataFrame) -> DataFrame:
    g = results.agg(F.count("*").alias("total_requests"), _sum(ok()).alias("successes"), _sum(~ok()).alias("failures"), _avg().alias("avg_response_time_sec"))
    return g.withColumn("success_rate_pct", percent(F.col("successes"), F.col("total_requests")))


def error_distribution(results: DataFrame) -> DataFrame:
    """Failures by type; a missing type is a group too."""
    return _share(results.where(~ok()).groupBy("error_type").agg(F.count("*").alias("count")), "error_type")


def top_failing_domains(results: DataFrame, least: int = 3, n: int = 20) -> DataFrame:
    g = results.groupBy("domain").agg(F.count("*").alias("attempts"), _n(~ok()).alias("failures")).where(F.col("attempts") >= least)
    return g.withColumn("failure_rate_pct", percent(F.col("failures"), F.col("attempts"))).orderBy(F.desc("failure_rate_pct"), "domain").limit(n)


def hourly_recent(results: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    g = recent(results, as_of, f"{hours} HOURS").groupBy(F.date_trunc("hour", "crawl_time").alias("hour")).agg(F.count("*").alias("total"), _n(ok()).alias("successes"))
    return g.withColumn("success_rate_pct", percent(F.col("successes"), F.col("total")))


def response_times(results: DataFrame) -> DataFrame:
    known = results.where("response_time is not null").withColumn("status", F.when(ok(), "Success").otherwise("Failure"))
    g = quantiles(known, "status", "response_time", {"median_sec": 0.5, "p95_sec": 0.95, "max_sec": 1.0}, {"count": F.lit(1), "_time": F.col("response_time")})
    return g.select("status", "count", F.round(F.try_divide("_time", "count"), 2).alias("avg_time_sec"), *[F.round(c, 2).alias(c) for c in ("median_sec", "p95_sec", "max_sec")])


def timeout_domains(results: DataFrame, n: int = 20) -> DataFrame:
    return results.where("error_type = 'timeout'").groupBy("domain").agg(F.count("*").alias("timeout_count"), _avg().alias("avg_time_before_timeout")).orderBy(F.desc("timeout_count"), "domain").limit(n)


def status_distribution(results: DataFrame) -> DataFrame:
    return _share(results.where("status_code is not null").groupBy("status_code").agg(F.count("*").alias("count")), "status_code")


def worker_comparison(results: DataFrame) -> DataFrame:
    g = results.where("worker_id is not null").groupBy("worker_id").agg(F.count("*").alias("total"), _n(ok()).alias("successes"), _avg().alias("avg_response_time"))
    return g.withColumn("success_rate_pct", percent(F.col("successes"), F.col("total")))


def error_trend(results: DataFrame, as_of: str, minutes: int = 60, bucket: int = 5) -> DataFrame:
    g = recent(results, as_of, f"{minutes} MINUTES").groupBy(F.window("crawl_time", f"{bucket} minutes").start.alias("time_bucket")).agg(F.count("*").alias("total"), _n(~ok()).alias("failures"))
    return g.withColumn("failure_rate_pct", percent(F.col("failures"), F.col("total")))


def retry_candidates(results: DataFrame, as_of: str, hours: int = 6, least: int = 3, n: int = 20) -> DataFrame:
    g = recent(results.where(~ok()), as_of, f"{hours} HOURS").groupBy("domain").agg(F.count("*").alias("failure_count"), F.max("crawl_time").alias("last_failure"), F.array_join(F.sort_array(F.collect_set("error_type")), ",").alias("error_types"))
    return g.where(F.col("failure_count") >= least).orderBy(F.desc("failure_count"), "domain").limit(n)


def domain_detail(results: DataFrame, domain: str) -> DataFrame:
    """A domain's attempts by outcome: one row per error type, successes with a null type."""
    return results.where(F.col("domain") == domain).groupBy("success", "error_type").agg(F.count("*").alias("count"), _avg().alias("avg_response_time"), F.max("crawl_time").alias("last_seen"))


def hourly_crawl_stats(pages: DataFrame) -> DataFrame:
    g = pages.groupBy(F.date_trunc("hour", "crawled_at").alias("stat_hour")).agg(F.count("*").alias("total_processed"), _n(F.col("processor") == "fast").alias("fast_processed"), _n(F.col("processor") == "rich").alias("rich_processed"), F.round(F.avg("static_score"), 2).alias("avg_static_score"), F.sum("raw_size_bytes").alias("total_raw_bytes"), F.sum("markdown_size_bytes").alias("total_markdown_bytes"))
    return g.withColumn("total_crawled", F.col("total_processed"))


def hourly_view(stats: DataFrame) -> DataFrame:
    return stats.select("stat_hour", "total_crawled", "total_processed", "fast_processed", "rich_processed", percent(F.col("fast_processed"), F.col("total_processed")).alias("fast_ratio"), "avg_static_score", F.expr("total_raw_bytes div 1024 div 1024").alias("total_raw_mb"), F.expr("total_markdown_bytes div 1024 div 1024").alias("total_markdown_mb"))


def top_domains(pages: DataFrame, n: int = 100) -> DataFrame:
    g = pages.groupBy("domain").agg(F.count("*").alias("page_count"), F.round(F.avg("static_score"), 2).alias("avg_score"), _n(F.col("processor") == "fast").alias("fast_count"), _n(F.col("processor") == "rich").alias("rich_count"))
    return g.orderBy(F.desc("page_count"), "domain").limit(n)


def stats_summary(pages: DataFrame, as_of: str) -> DataFrame:
    last = F.col("crawled_at") > F.expr(f"timestamp '{as_of}' - interval 1 HOUR")
    return pages.agg(F.count("*").alias("total"), _n(F.col("processor") == "fast").alias("fast"), _n(F.col("processor") == "rich").alias("rich"), _n(last).alias("last_hour"), F.round(F.avg("static_score"), 2).alias("avg_score"))


def embedding_stats(chunks: DataFrame) -> DataFrame:
    g = chunks.where("embedding is not null").agg(F.count_distinct("url").alias("urls_embedded"), F.count("*").alias("total_chunks"), F.avg(F.size("embedding")).alias("avg_dimension"), F.min("created_at").alias("first_created"), F.max("created_at").alias("last_created"))
    return g.withColumn("avg_chunks_per_url", F.round(ratio(F.col("total_chunks"), F.col("urls_embedded")), 2))


def domain_lengths(crawled: DataFrame) -> DataFrame:
    return crawled.groupBy("domain").agg(F.count("*").alias("page_count"), F.round(F.avg(F.length("content_text")), 2).alias("avg_content_length"))


def crawler_stats(crawled: DataFrame, as_of: str) -> DataFrame:
    """Counts in nested windows, domains and mean length of a day, in one pass; the total counts all rows."""

    def since(interval: str) -> Column:
        return F.col("created_at") > F.expr(f"timestamp '{as_of}' - interval {interval}")

    day = since("24 HOURS")
    mean = F.avg(F.when(day, F.length("content_text")))
    return crawled.agg(F.count("*").alias("total_pages"), _n(since("1 MINUTE")).alias("pages_last_1min"), _n(since("5 MINUTES")).alias("pages_last_5min"), _n(since("1 HOUR")).alias("pages_last_1hour"), F.count_distinct(F.when(day, F.col("domain"))).alias("unique_domains"), F.round(F.coalesce(mean, F.lit(0.0))).cast("long").alias("avg_content_length"))


def dlq_stats(dlq: DataFrame, as_of: str) -> DataFrame:
    last = F.col("created_at") > F.expr(f"timestamp '{as_of}' - interval 1 HOUR")
    return dlq.agg(F.count("*").alias("dlq_total"), _n(last).alias("dlq_last_1hour"), _n(F.col("error_type") == "DataError").alias("dlq_data_errors"), _n(F.col("error_type") == "UniqueViolationError").alias("dlq_unique_errors"))


def dlq_stats_if_exists(spark, name: str, as_of: str) -> DataFrame:
    """The same, or one row of zeros if there is no such table."""
    if spark.catalog.tableExists(name):
        return dlq_stats(spark.table(name), as_of)
    return spark.range(1).select(*(F.lit(0).cast("long").alias(c) for c in ("dlq_total", "dlq_last_1hour", "dlq_data_errors", "dlq_unique_errors")))


def throughput(crawled: DataFrame, as_of: str) -> DataFrame:
    return crawled.agg((_n(F.col("created_at") > F.expr(f"timestamp '{as_of}' - interval 1 MINUTE")).cast("double") / 60).alias("pages_per_second"))


def domain_totals(crawled: DataFrame, as_of: str, n: int = 10) -> DataFrame:
    g = recent(crawled, as_of, "24 HOURS", "created_at").groupBy("domain").agg(F.count("*").alias("page_count"))
    total = g.agg(F.count("*").alias("domain_count")).select(F.lit("total").alias("metric_type"), "domain_count")
    top = g.orderBy(F.desc("page_count"), "domain").limit(n).agg(F.coalesce(F.sum("page_count"), F.lit(0)).alias("domain_count"))
    return total.unionByName(top.select(F.lit("top_10_total").alias("metric_type"), "domain_count"))


def total_stats(crawled: DataFrame, as_of: str) -> DataFrame:
    last = F.col("created_at") > F.expr(f"timestamp '{as_of}' - interval 1 HOUR")
    return crawled.agg(F.count("*").alias("estimated_total_pages"), F.count_distinct(F.when(last, F.col("domain"))).alias("unique_domains_1h"))


#: The size of a sketch of distinct values (2 to this power) and three standard errors of its estimate.
SKETCH, SKETCH_ERROR = 12, 0.05


def hourly_sketches(rows: DataFrame, time: str = "created_at", value: str = "domain") -> DataFrame:
    """Per hour the number of rows and a sketch of the distinct values, which is merged with others for any window; null values count as rows alone."""
    return rows.groupBy(F.date_trunc("hour", time).alias("hour")).agg(F.count("*").alias("n"), F.hll_sketch_agg(value, SKETCH).alias("sketch"))


def merged_sketches(*tables: DataFrame) -> DataFrame:
    """Sketches of several batches of rows as one table of hours."""
    rows = functools.reduce(DataFrame.unionByName, tables)
    return rows.groupBy("hour").agg(F.sum("n").alias("n"), F.hll_union_agg("sketch").alias("sketch"))


def estimated_totals(sketches: DataFrame, width: str = "1 day", slide: str | None = None) -> DataFrame:
    """Windows of hours: rows and the estimated number of distinct values, within ``SKETCH_ERROR`` of it in 997 of 1000 cases."""
    g = sketches.groupBy(F.window("hour", width, slide or width).alias("w"))
    return g.agg(F.sum("n").alias("estimated_total"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimated_distinct")).select(F.col("w.start").alias("start"), "estimated_total", "estimated_distinct")


def domain_stats(pages: DataFrame) -> DataFrame:
    """Per domain: pages, mean score, the processor of most pages (the smaller name on a tie), last crawl."""
    g = pages.groupBy("domain", "processor").agg(F.count("*").alias("n"), F.sum("static_score").alias("s"), F.max("crawled_at").alias("t"))
    g = g.groupBy("domain").agg(F.sum("n").alias("page_count"), F.sum("s").alias("s"), F.min_by("processor", F.struct(-F.col("n"), F.col("processor"))).alias("dominant_processor"), F.max("t").alias("last_crawled_at"))
    return g.select("domain", "page_count", F.round(ratio(F.col("s"), F.col("page_count")), 2).alias("avg_score"), "dominant_processor", "last_crawled_at")


def score_histogram(scored: DataFrame) -> DataFrame:
    from ..functions.scoring import score_bucket

    return scored.groupBy(score_bucket(F.col("score")).alias("bucket")).agg(F.count("*").alias("n"), F.round(F.avg("raw_score"), 2).alias("avg_raw_score"), F.round(ratio(_n(F.col("route") == "fast"), F.count("*")), 4).alias("fast_ratio"))


def run_statistics(results: DataFrame, seconds: float) -> DataFrame:
    """Rates of a run: success rate, requests a second, mean time; 0 where a denominator is 0."""
    return results.agg(F.count("*").alias("total"), _n(ok()).alias("succeeded"), F.round(ratio(_n(ok()), F.count("*")), 4).alias("success_rate"), F.round(F.count("*") / F.lit(float(seconds)), 4).alias("requests_per_second"), F.round(F.coalesce(F.avg("response_time"), F.lit(0.0)), 4).alias("avg_time"))


def size_statistics(pages: DataFrame) -> DataFrame:
    a, b = F.sum("raw_size_bytes"), F.sum("markdown_size_bytes")
    return pages.agg(a.alias("original_bytes"), b.alias("kept_bytes"), (a - b).alias("saved_bytes"), F.round(ratio(a - b, a), 4).alias("ratio"))


def pool_statistics(results: DataFrame) -> DataFrame:
    """Each worker of a pool and the pool itself (null worker), by grouping sets in one pass."""
    g = results.where("worker_id is not null").rollup("worker_id").agg(F.count("*").alias("processed"), _n(~ok()).alias("failed"), F.grouping("worker_id").cast("int").alias("is_pool"))
    return g.withColumn("error_rate", F.round(ratio(F.col("failed"), F.col("processed")), 4))


def index_totals(results: DataFrame) -> DataFrame:
    return results.agg(F.count("*").alias("n_rows"), F.count_distinct("domain").alias("n_domains"))


def crawl_summary(results: DataFrame) -> DataFrame:
    """Totals of a crawl: domains, pages, errors, their rate and the mean time between; rates are 0 without pages."""
    return results.agg(F.count_distinct("domain").alias("domains"), F.count("*").alias("pages"), _n(~ok()).alias("errors"), F.round(ratio(_n(~ok()), F.count("*")), 4).alias("error_rate"), F.round(F.coalesce(F.avg("response_time"), F.lit(0.0)), 4).alias("avg_delay"))


def dashboard(results: DataFrame) -> DataFrame:
    """Per shard: tried, succeeded, failed, the most frequent error (smaller name on a tie) and its count."""
    g = results.groupBy("shard_id", "error_type").agg(F.count("*").alias("n"), _n(ok()).alias("s"))
    best = F.min_by(F.col("error_type"), F.when(F.col("error_type").isNotNull(), F.struct(-F.col("n"), F.col("error_type"))))
    return g.groupBy("shard_id").agg(F.sum("n").alias("tried"), F.sum("s").alias("succeeded"), (F.sum("n") - F.sum("s")).alias("failed"), best.alias("top_error"), F.max(F.when(F.col("error_type").isNotNull(), F.col("n"))).alias("top_error_count"))
