"""Spark-first analytics for crawled pages: scoring, extraction, frontier, reports, search."""
