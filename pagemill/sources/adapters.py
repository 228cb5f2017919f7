"""The crawler's tables, derived from the driver's synthetic ones by fixed rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars, scoring

#: The moment that stands for "now" in every relative window.
AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crawl_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    failed = F.col("event_type") == "error"
    kind = F.element_at(F.array(*map(F.lit, ("timeout", "ssl_error", "connection_error", "dns_error", "content_error"))), (F.col("user_id") % 5 + 1).cast("int"))
    status = F.when(F.col("event_id") % 7 == 0, F.lit(None)).when(~failed, 200).otherwise(F.element_at(F.array(*map(F.lit, (200, 403, 404, 429, 500, 503, 301))), (F.col("event_id") % 7 + 1).cast("int")))
    domain = F.concat(F.lit("d"), (F.col("event_id") * 7919) % 4001, F.lit(".example.com"))
    return e.select(F.col("event_id").alias("id"), F.concat(F.lit("https://"), domain, F.lit("/p/"), F.col("event_id")).alias("url"), domain.alias("domain"), (~failed).alias("success"), F.when(failed & (F.col("event_id") % 11 != 0), kind).alias("error_type"), F.when(failed, F.concat(kind, F.lit(" while fetching"))).alias("error_message"), status.cast("int").alias("status_code"), F.when(F.col("event_id") % 13 != 0, F.col("value") / 100.0).alias("response_time"), (F.col("event_id") % 5000).cast("int").alias("content_length"), F.when(F.col("user_id") % 10 != 9, F.col("user_id") % 8).cast("int").alias("worker_id"), (F.col("event_id") % 3).cast("int").alias("shard_id"), F.lit(1).alias("attempt"), F.col("ts").alias("crawl_time"))


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages: scored, routed, keyed; crawled a minute apart by id."""
    p = scoring.analyse(raw_pages(spark, sf_dir)).withColumn("processor", F.when(F.col("page_id") % 4 == 0, "rich").otherwise(F.col("route")))
    return p.select(F.col("page_id").alias("id"), "url", scalars.netloc("url").alias("domain"), F.regexp_extract("html", r"(?is)<title[^>]*>([^<]*)</title>", 1).alias("title"), F.regexp_extract("html", r'(?is)<html[^>]*lang="([^"]*)"', 1).alias("language"), "processor", F.greatest(F.lit(0), F.col("raw_score") - 60 - F.col("page_id") % 40).cast("int").alias("static_score"), "route_reason", scalars.object_key("url", "html").alias("raw_html_key"), scalars.object_key("url", "md").alias("markdown_key"), F.octet_length("html").cast("long").alias("raw_size_bytes"), F.col("text_length").cast("long").alias("markdown_size_bytes"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("page_id").cast("int"))).alias("crawled_at"), F.lit(1).alias("version"))


def page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with vectors: each vector belongs to a page; the last tenth names pages that are not stored."""
    e, n = table(spark, sf_dir, "embeddings"), raw_pages(spark, sf_dir).agg(F.count("*").alias("n_pages"))
    e = e.join(F.broadcast(n), how="cross")  # one row
    return e.join(raw_pages(spark, sf_dir).select("page_id", "url"), F.col("vec_id") % F.col("n_pages") == F.col("page_id"), "left").select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 10 == 0, F.concat("url", F.lit("#gone"))).otherwise(F.col("url")).alias("url"), F.expr("cast(vec_id div n_pages as int)").alias("chunk_index"), F.concat(F.lit("chunk "), F.col("vec_id"), F.lit(" of topic "), F.col("label")).alias("chunk_text"), F.when(F.col("label") % 2 == 0, F.concat(F.lit("Topic "), F.col("label"))).alias("heading_ctx"), "embedding", (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("vec_id").cast("int"))).alias("created_at"))


def crawled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older page table, from events: one row per event with a text length."""
    c = crawl_results(spark, sf_dir).where("success")
    return c.select("url", "domain", F.repeat(F.lit("x"), F.col("content_length") % 50).alias("content_text"), F.col("crawl_time").alias("created_at"))


def crawler_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = crawl_results(spark, sf_dir).where("not success")
    return c.select("url", "error_message", F.when(F.col("id") % 3 == 0, "DataError").when(F.col("id") % 3 == 1, "UniqueViolationError").otherwise("Other").alias("error_type"), F.col("crawl_time").alias("created_at"))
