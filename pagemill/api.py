"""The service's entry points as functions on tables: health, search, statistics, chunks, analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import chunking, html, scoring
from .operators import merge, search
from .plans import reports


class NotFound(LookupError):
    """There is nothing under the given URL."""


def health(spark: SparkSession) -> dict:
    return {"status": "ok", "spark": spark.version}


def find(chunks: DataFrame, pages: DataFrame, text: str, k: int = search.TOP_K, min_similarity: float = search.MIN_SIMILARITY, domain: str | None = None, embedder=None) -> DataFrame:
    """Search by text; k is 1 to 50, similarity is rounded to four digits."""
    if not text.strip():
        raise ValueError("empty query")
    if not 0 <= min_similarity <= 1:
        raise ValueError("min_similarity must be 0 to 1")
    query = (embedder or chunking.create_embedder()).embed_batch([text])[0].tolist()
    return search.search(chunks, pages, query, k, min_similarity, domain)


def stats(chunks: DataFrame) -> dict:
    """Embedding statistics; total_urls and avg_chunks_per_url are filled."""
    r = reports.embedding_stats(chunks).first().asDict()
    return r | {"total_urls": r["urls_embedded"]}


def chunks(chunk_table: DataFrame, pages: DataFrame, url: str) -> list[dict]:
    """All of a page's chunks in order; ``NotFound`` if there are none."""
    rows = search.chunks_of(chunk_table, pages, url).collect()  # as many as one page has
    if not rows:
        raise NotFound(url)
    return [r.asDict() for r in rows]


def analyse(pages: DataFrame, threshold: int = scoring.THRESHOLD) -> DataFrame:
    """Score, route, metadata, technology and counts of pages."""
    p = scoring.analyse(pages, threshold=threshold)
    return p.select(*[c for c in p.columns if c != "html" and c not in scoring.COUNTS], html.metadata("html").alias("metadata"), scoring.frameworks("html").alias("frameworks"), scoring.cms("html").alias("cms"), scoring.analytics("html").alias("analytics"), *scoring.element_counts("html"))


def analyse_text(spark: SparkSession, text: str, url: str = "", threshold: int = scoring.THRESHOLD) -> DataFrame:
    return analyse(spark.createDataFrame([(url, text)], "url string, html string"), threshold)


def process(pages: DataFrame, threshold: int = scoring.THRESHOLD) -> DataFrame:
    """Raw pages to extraction results by route."""
    return html.process(scoring.analyse(pages, threshold=threshold)).withColumn("processor_type", F.col("route"))


def embed(results: DataFrame, embedder=None, most_chunks: int | None = None) -> DataFrame:
    """Chunk rows with vectors of successful results: all chunks of a page, or its first ``most_chunks``."""
    rows = chunking.chunk_rows(results.withColumn("markdown", F.col("extracted.markdown")), most_chunks=most_chunks, success="success")
    return rows.withColumn("embedding", chunking.embedding("chunk_text", embedder))


def backfill(chunk_table: DataFrame, pages: DataFrame) -> DataFrame:
    return merge.backfill_page_ids(chunk_table, pages)


def failure_report(results: DataFrame, as_of: str | None = None, hours: int | None = None, domain: str | None = None) -> dict[str, DataFrame]:
    """The sections of the failure report as plans."""
    r = reports.recent(results, as_of, f"{hours} HOURS") if hours and as_of else results
    out = {"overall": reports.overall(r), "errors": reports.error_distribution(r), "domains": reports.top_failing_domains(r), "times": reports.response_times(r)}
    return out | ({"domain": reports.domain_status(r, domain), "domain_errors": reports.domain_detail(r, domain)} if domain else {})


def validate_metrics(summary: DataFrame, required: list[str]) -> list[str]:
    """Names of required metrics that have no samples."""
    there = {r["name"] for r in summary.where(F.col("name").isin(required)).select("name").distinct().collect()}
    return [n for n in required if n not in there]
