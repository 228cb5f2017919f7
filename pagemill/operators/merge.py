"""Upserts as joins: new rows of a key meet the stored row, and the result replaces the table.

Several arrivals of a key in a batch count each: the last by arrival wins, the version grows by their number. Of arrivals at one time that
which was crawled first counts, where rows tell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Columns of ``pages`` that a new arrival overwrites; domain and crawled_at keep their first value.
PAGE_UPDATED = ("title", "description", "language", "keywords", "processor", "static_score", "route_reason", "raw_html_key", "markdown_key", "raw_size_bytes", "markdown_size_bytes", "status_code", "content_type", "processed_at")
CHUNK_UPDATED = ("page_id", "chunk_text", "heading_ctx", "embedding", "created_at")
MESSAGE_CHARS = 1000


def arrivals(batch: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """One row per key: the last arrival's values, the first's under ``_first``, and ``_arrivals``. Pre-aggregated."""
    rest = [c for c in batch.columns if c not in keys]
    row, last, first = F.struct(*rest), F.col(arrival), F.col(arrival)
    if "crawled_at" in rest:
        crawled = F.unix_micros(F.col("crawled_at").cast("timestamp"))
        last, first = (F.when(F.col(arrival).isNotNull(), F.struct(arrival, x.alias("crawled"))) for x in (-crawled, crawled))
    g = batch.groupBy(*keys).agg(F.max_by(row, last).alias("_last"), F.min_by(row, first).alias("_first"), F.count("*").alias("_arrivals"))
    return g.select(*keys, "_last.*", "_first", "_arrivals")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], updated: tuple[str, ...], arrival: str, version: str | None = None) -> DataFrame:
    """The table after the batch. Stored columns outside ``updated`` stay; new keys take the first arrival's."""
    new = arrivals(batch, keys, arrival).withColumn("_new", F.lit(True)).alias("n")
    old = target.withColumn("_old", F.lit(True)).alias("o")
    both = old.join(new, keys, "full")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c == version:
            out.append((F.coalesce(F.col(f"o.{c}"), F.lit(0)) + F.coalesce("_arrivals", F.lit(0))).cast(target.schema[c].dataType).alias(c))
        elif c not in batch.columns:
            out.append(F.col(f"o.{c}").alias(c))
        elif c in updated:
            out.append(F.when(F.col("_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            out.append(F.when(F.col("_old"), F.col(f"o.{c}")).otherwise(F.col(f"_first.{c}")).alias(c))
    return both.select(*out)


def upsert_pages(pages: DataFrame, batch: DataFrame, arrival: str = "processed_at") -> DataFrame:
    return upsert(pages, batch, ["url"], PAGE_UPDATED, arrival, "version")


def upsert_chunks(chunks: DataFrame, batch: DataFrame, arrival: str = "created_at") -> DataFrame:
    """Chunks by (url, chunk_index); higher indexes of an older, longer text stay."""
    return upsert(chunks, batch, ["url", "chunk_index"], CHUNK_UPDATED, arrival)


def backfill_page_ids(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """Chunks without a page id get that of the page with their URL."""
    ids = pages.select("url", F.col("id").alias("_id"))
    return chunks.join(ids, "url", "left").withColumn("page_id", F.coalesce("page_id", "_id")).drop("_id").select(*chunks.columns)


def upsert_hourly(stats: DataFrame, fresh: DataFrame) -> DataFrame:
    """Hourly counters grow by the new ones; total_crawled is set only when an hour begins."""
    counters = [c for c in ("total_processed", "fast_processed", "rich_processed", "total_raw_bytes", "total_markdown_bytes") if c in stats.columns and c in fresh.columns]
    o, n = stats.alias("o"), fresh.alias("n")
    kept = [F.coalesce("o.total_crawled", "n.total_crawled").alias("total_crawled")] if "total_crawled" in stats.columns else []
    return o.join(n, "stat_hour", "full").select("stat_hour", *kept, *((F.coalesce(f"o.{c}", F.lit(0)) + F.coalesce(f"n.{c}", F.lit(0))).alias(c) for c in counters))


def first_by_url(batch: DataFrame, arrival: str) -> DataFrame:
    """The first arrival of each URL of a batch."""
    return batch.groupBy("url").agg(F.min_by(F.struct(*[c for c in batch.columns if c != "url"]), arrival).alias("r")).select("url", "r.*")


def upsert_crawled(crawled: DataFrame, batch: DataFrame, arrival: str = "created_at") -> DataFrame:
    """The older page table: the first arrival in a batch overwrites all but url and created_at."""
    return upsert(crawled, first_by_url(batch, arrival), ["url"], tuple(c for c in crawled.columns if c not in ("url", "created_at")), arrival)


def dead_letters(batch: DataFrame, error_type, message, created_at) -> DataFrame:
    """Rows for the dead-letter table: the record as JSON, the message cut, NUL characters dropped."""
    def bare(c):
        return F.translate(c, "\0", "")

    return batch.select("url", bare(F.substring(message, 1, MESSAGE_CHARS)).alias("error_message"), error_type.alias("error_type"), bare(F.to_json(F.struct(*batch.columns))).alias("raw_data"), created_at.alias("created_at"))


def split_valid(batch: DataFrame, required: tuple[str, ...] = ("url", "crawled_at")) -> tuple[DataFrame, DataFrame]:
    """Rows that have all required columns, and the others."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return batch.where(ok), batch.where(~ok)


def page_records(results: DataFrame) -> DataFrame:
    """Processed results (url, success, processor_type, extracted, score, ...) as page rows with defaults.

    Only successes with Markdown are stored. Zero times count as missing; such rows are for the dead letters.
    """
    from ..functions import scalars as S

    x = F.col("extracted")
    domain = F.coalesce(F.nullif(S.netloc("url"), F.lit("")), F.lit("unknown"))
    rows = results.where(F.col("success") & (F.length(x["markdown"]) > 0))
    return rows.select("url", domain.alias("domain"), x["title"].alias("title"), x["description"].alias("description"), x["language"].alias("language"), F.coalesce(x["keywords"], F.array()).alias("keywords"), F.coalesce("processor_type", F.lit("fast")).alias("processor"), F.coalesce("score", F.lit(0)).alias("static_score"), "route_reason", S.object_key("url", "html").alias("raw_html_key"), S.object_key("url", "md").alias("markdown_key"), x["content_length"].cast("long").alias("raw_size_bytes"), x["markdown_length"].cast("long").alias("markdown_size_bytes"), "status_code", "content_type", S.epoch_to_time("original_timestamp").alias("crawled_at"), S.epoch_to_time("processor_timestamp").alias("processed_at"))


def last_n(history: DataFrame, key: str, time: str, n: int) -> DataFrame:
    """The newest ``n`` rows of each key."""
    w = Window.partitionBy(key).orderBy(F.desc(time))
    return history.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")
