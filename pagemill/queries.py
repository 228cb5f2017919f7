"""Queries over the adapted tables, each with SQL that an independent engine runs for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scoring
from .plans import metrics, reports
from .sources import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: Queries of the same kind that read no given table, for the tests alone.
FIXED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
FIXED_SQL: dict[str, str] = {}

#: crawl_results in the other engine's SQL.
CR = """cr as (select event_id as id, 'https://d' || ((event_id*7919) % 4001) || '.example.com/p/' || event_id as url, 'd' || ((event_id*7919) % 4001) || '.example.com' as domain,
 event_type <> 'error' as success,
 case when event_type = 'error' and event_id % 11 <> 0 then ['timeout','ssl_error','connection_error','dns_error','content_error'][(user_id % 5 + 1)::int] end as error_type,
 case when event_type = 'error' then ['timeout','ssl_error','connection_error','dns_error','content_error'][(user_id % 5 + 1)::int] || ' while fetching' end as error_message,
 case when event_id % 7 = 0 then null when event_type <> 'error' then 200 else [200,403,404,429,500,503,301][(event_id % 7 + 1)::int] end::int as status_code,
 case when event_id % 13 <> 0 then value / 100.0 end as response_time, (event_id % 5000)::int as content_length,
 case when user_id % 10 <> 9 then (user_id % 8)::int end as worker_id, (event_id % 3)::int as shard_id, ts as crawl_time from events)"""
CRAWLED = CR + ", cp as (select url, domain, repeat('x', content_length % 50) as content_text, crawl_time as created_at from cr where success)"
DLQ = CR + ", dlq as (select url, case id % 3 when 0 then 'DataError' when 1 then 'UniqueViolationError' else 'Other' end as error_type, crawl_time as created_at from cr where not success)"
NOW = f"timestamp '{A.AS_OF}'"


def _rule_sql() -> tuple[str, str]:
    hits, total = [], []
    for i, (_, d, p) in enumerate(scoring.DYNAMIC):
        q = p.replace("'", "''")
        hits.append(f"regexp_matches(html, '{q}', 'in') as h{i}")
        total.append(f"(case when h{i} then {d} else 0 end)")
    for i, (_, d, p, dot) in enumerate(scoring.STATIC, len(scoring.DYNAMIC)):
        q = p.replace("'", "''")
        hits.append(f"regexp_matches(html, '{q}', '{'is' if dot else 'in'}') as h{i}")
        total.append(f"(case when h{i} then {d} else 0 end)")
    return ", ".join(hits), " + ".join(total)


_HITS, _TOTAL = _rule_sql()
_TEXT = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<script[^>]*>.*?</script>', '', 'gis'), '<style[^>]*>.*?</style>', '', 'gis'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"
SCORED = f"""m as (select *, length({_TEXT}) as text_length, len(regexp_extract_all(html, '<script[^>]*>', 0, 'i')) as script_count, {_HITS} from pages),
 r as (select *, 100 + (case when text_length < 300 then -35 when text_length < 500 then -20 when text_length > 5000 then 15 when text_length > 2000 then 10 else 0 end)
 + (case when script_count > 20 then -15 when script_count > 10 then -5 else 0 end) + {_TOTAL} as raw_score from m),
 s as (select *, greatest(0, least(100, raw_score)) as score, case when greatest(0, least(100, raw_score)) >= 80 then 'fast' else 'rich' end as route, regexp_extract(url, '^(?:[^:/?#]+:)?//([^/?#]*)', 1) as domain from r)"""
_KEY = "substr(sha256(url), 1, 2) || '/' || substr(sha256(url), 3, 2) || '/' || substr(sha256(url), 1, 16)"
PAGES = SCORED + f""", pg as (select page_id as id, url, domain, case when page_id % 4 = 0 then 'rich' else route end as processor, greatest(0, raw_score - 60 - page_id % 40)::int as static_score,
 domain || '/' || {_KEY} || '.md' as markdown_key, strlen(html) as raw_size_bytes, text_length as markdown_size_bytes,
 timestamp '2024-01-01' + to_minutes(page_id) as crawled_at, regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1, 'is') as title, regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1, 'is') as language from s)"""
CHUNKS = """np as (select count(*) as n from pages), ch as (select vec_id as id, case when vec_id % 10 = 0 then p.url || '#gone' else p.url end as url, (vec_id // n)::int as chunk_index,
 'chunk ' || vec_id || ' of topic ' || label as chunk_text, case when label % 2 = 0 then 'Topic ' || label end as heading_ctx, embedding, timestamp '2024-01-01' + to_minutes(vec_id) as created_at
 from embeddings, np left join pages p on p.page_id = vec_id % n)"""


def pct(a: str, b: str) -> str:
    return f"round(case when {b} <> 0 then ({a})::double * 100.0 / ({b})::double end, 2)"


def query(sql: str | None = None, name: str | None = None, fixed: bool = False):
    """Registers a query under its function's name, with its SQL; ``fixed`` ones, which read no given table, for the tests alone."""
    of, sqls = (FIXED, FIXED_SQL) if fixed else (QUERIES, ORACLE)

    def add(f):
        key = name or f.__name__
        of[key] = f
        if sql:
            sqls[key] = sql
        return f

    return add


OKN, BADN = "sum(case when success then 1 else 0 end)", "sum(case when success then 0 else 1 end)"
AVG = "round(avg(response_time), 2)"


# --- scoring and routing ---------------------------------------------------------------------------------


@query(f"with {SCORED} select route, count(*) as n, round(avg(raw_score), 2) as avg_raw_score, min(raw_score) as min_raw_score, max(raw_score) as max_raw_score from s group by route")
def page_routes(spark, d):
    p = scoring.analyse(A.raw_pages(spark, d))
    return p.groupBy("route").agg(F.count("*").alias("n"), F.round(F.avg("raw_score"), 2).alias("avg_raw_score"), F.min("raw_score").alias("min_raw_score"), F.max("raw_score").alias("max_raw_score"))


@query(f"with {SCORED} select page_id, text_length, script_count, raw_score, score, route, domain from s")
def page_scores(spark, d):
    from .functions.scalars import netloc

    p = scoring.analyse(A.raw_pages(spark, d))
    return p.select("page_id", F.col("text_length").cast("long"), F.col("script_count").cast("long"), F.col("raw_score").cast("int"), F.col("score").cast("int"), "route", netloc("url").alias("domain"))


@query(f"with {SCORED} select page_id, case when score >= 80 then 'Score ' || score || ' >= 80: Static page, suitable for BeautifulSoup' else 'Score ' || score || ' < 80: Dynamic page, requires Crawl4AI' end as route_reason from s")
def page_route_reasons(spark, d):
    return scoring.analyse(A.raw_pages(spark, d)).select("page_id", "route_reason")


def _reason_sql() -> str:
    names = [(n, d) for n, d, _ in scoring.DYNAMIC] + [(n, d) for n, d, *_ in scoring.STATIC]
    found = ", ".join(f"case when h{i} then '{n} ({x:+d})' end" for i, (n, x) in enumerate(names))
    return f"""list_filter([case when text_length < 300 then 'Very short content (' || text_length || ' chars) (-35)' when text_length < 500 then 'Short content (' || text_length || ' chars) (-20)'
 when text_length > 5000 then 'Rich content (' || text_length || ' chars) (+15)' when text_length > 2000 then 'Good content (' || text_length || ' chars) (+10)' end,
 case when script_count > 20 then 'Many scripts (' || script_count || ') (-15)' when script_count > 10 then 'Several scripts (' || script_count || ') (-5)' end, {found}], lambda x: x is not null)"""


@query(f"with {SCORED} select page_id, array_to_string({_reason_sql()}[1:5], '; ') as score_reasons from s")
def page_score_reasons(spark, d):
    return scoring.analyse(A.raw_pages(spark, d)).select("page_id", F.array_join("score_reasons", "; ").alias("score_reasons"))


@query(f"with {SCORED} select case when score <= 20 then '0-20' when score <= 40 then '21-40' when score <= 60 then '41-60' when score <= 80 then '61-80' else '81-100' end as bucket, count(*) as n, round(avg(raw_score), 2) as avg_raw_score, round(avg(case when route = 'fast' then 1.0 else 0.0 end), 4) as fast_ratio from s group by 1")
def score_histogram(spark, d):
    return reports.score_histogram(scoring.analyse(A.raw_pages(spark, d)))


def _named_sql(table, joined: bool) -> str:
    found = ", ".join(f"case when regexp_matches(lower(html), '{p}', 'n') then '{n}' end" for n, p in table)
    return f"array_to_string(list_filter([{found}], lambda x: x is not null), ',')" if joined else f"coalesce({found})"


@query(f"select page_id, {_named_sql(scoring.FRAMEWORKS, True)} as frameworks, {_named_sql(scoring.CMS, False)} as cms, {_named_sql(scoring.ANALYTICS, True)} as analytics from pages")
def page_tech_stack(spark, d):
    return A.raw_pages(spark, d).select("page_id", F.array_join(scoring.frameworks("html"), ",").alias("frameworks"), scoring.cms("html").alias("cms"), F.array_join(scoring.analytics("html"), ",").alias("analytics"))


@query("select page_id, " + ", ".join(f"len(regexp_extract_all(html, '{p}', 0, 'i')) as {n}" for n, p in scoring.COUNTS.items()) + f", length({_TEXT}) as text_length, case when {_TEXT} = '' then 0 else len(string_split({_TEXT}, ' ')) end as word_count from pages")
def page_content_stats(spark, d):
    from .functions.scalars import word_count

    counts = [c.cast("long") for c in scoring.element_counts("html")]
    return A.raw_pages(spark, d).select("page_id", *[c.alias(n) for c, n in zip(counts, scoring.COUNTS, strict=True)], scoring.text_length("html").cast("long").alias("text_length"), word_count(scoring.plain_text("html")).cast("long").alias("word_count"))


# --- reports over crawl results --------------------------------------------------------------------------


def _cr(name: str, sql: str, plan: Callable[[DataFrame], DataFrame]) -> None:
    query(f"with {CR} {sql}", name)(lambda spark, d: plan(A.crawl_results(spark, d)))


_cr("error_stats", f"select error_type, count(*) as count, {pct('count(*)', '(select count(*) from cr where not success)')} as percentage, {AVG} as avg_response_time, round(max(response_time), 2) as max_response_time, min(crawl_time) as first_seen, max(crawl_time) as last_seen from cr where not success and error_type is not null group by error_type", reports.error_stats)
_cr("domain_failure_stats", f"select domain, count(*) as total_attempts, {OKN}::bigint as successes, {BADN}::bigint as failures, {pct(BADN, 'count(*)')} as failure_rate, {AVG} as avg_response_time, coalesce(array_to_string(list_sort(array_agg(distinct error_type) filter (where error_type is not null)), ','), '') as error_types from cr group by domain having count(*) >= 3", reports.domain_failure_stats)
_cr("hourly_success_stats", f"select date_trunc('hour', crawl_time) as hour, count(*) as total, {OKN}::bigint as successes, {BADN}::bigint as failures, {pct(OKN, 'count(*)')} as success_rate, {AVG} as avg_response_time from cr group by 1", reports.hourly_success)
_cr("worker_performance_stats", f"select worker_id, count(*) as total_requests, {OKN}::bigint as successes, {BADN}::bigint as failures, {pct(OKN, 'count(*)')} as success_rate, {AVG} as avg_response_time, round(percentile_cont(0.95) within group (order by response_time), 2) as p95_response_time from cr where worker_id is not null group by worker_id", reports.worker_performance)
_cr("recent_error_stats", f"select error_type, count(*) as count, {pct('count(*)', 'sum(count(*)) over ()')} as percentage, {AVG} as avg_response_time from cr where not success and crawl_time > {NOW} - interval '1440 minutes' and error_type is not null group by error_type", lambda r: reports.recent_error_stats(r, A.AS_OF, 1440))
_cr("domain_status", f"select count(*) as total_attempts, {OKN}::bigint as successes, {BADN}::bigint as failures, {pct(BADN, 'count(*)')} as failure_rate, max(case when success then crawl_time end) as last_success, max(case when not success then crawl_time end) as last_failure, coalesce(array_to_string(list_sort(array_agg(distinct error_type) filter (where error_type is not null)), ','), '') as common_errors from cr where domain = 'd7.example.com'", lambda r: reports.domain_status(r, "d7.example.com"))
_cr("overall_statistics", f"select count(*) as total_requests, {OKN}::bigint as successes, {BADN}::bigint as failures, {pct(OKN, 'count(*)')} as success_rate_pct, {AVG} as avg_response_time_sec from cr", reports.overall)
_cr("error_distribution", f"select error_type, count(*) as count, {pct('count(*)', '(select count(*) from cr where not success)')} as percentage from cr where not success group by error_type", reports.error_distribution)
_cr("top_failing_domains", f"select domain, count(*) as attempts, {BADN}::bigint as failures, {pct(BADN, 'count(*)')} as failure_rate_pct from cr group by domain having count(*) >= 3 order by failure_rate_pct desc, domain limit 20", reports.top_failing_domains)
_cr("hourly_success_last_day", f"select date_trunc('hour', crawl_time) as hour, count(*) as total, {OKN}::bigint as successes, {pct(OKN, 'count(*)')} as success_rate_pct from cr where crawl_time > {NOW} - interval '24 hours' group by 1", lambda r: reports.hourly_recent(r, A.AS_OF))
_cr("response_time_stats", f"select case when success then 'Success' else 'Failure' end as status, count(*) as count, round(avg(response_time), 2) as avg_time_sec, round(percentile_cont(0.5) within group (order by response_time), 2) as median_sec, round(percentile_cont(0.95) within group (order by response_time), 2) as p95_sec, round(max(response_time), 2) as max_sec from cr where response_time is not null group by success", reports.response_times)
_cr("timeout_domains", "select domain, count(*) as timeout_count, round(avg(response_time), 2) as avg_time_before_timeout from cr where error_type = 'timeout' group by domain order by timeout_count desc, domain limit 20", reports.timeout_domains)
_cr("status_distribution", f"select status_code, count(*) as count, {pct('count(*)', '(select count(*) from cr where status_code is not null)')} as percentage from cr where status_code is not null group by status_code", reports.status_distribution)
_cr("worker_comparison", f"select worker_id, count(*) as total, {OKN}::bigint as successes, {pct(OKN, 'count(*)')} as success_rate_pct, {AVG} as avg_response_time from cr where worker_id is not null group by worker_id", reports.worker_comparison)
_cr("error_trend", f"select date_trunc('minute', crawl_time) - (extract(minute from crawl_time)::int % 5) * interval '1 minute' as time_bucket, count(*) as total, {BADN}::bigint as failures, {pct(BADN, 'count(*)')} as failure_rate_pct from cr where crawl_time > {NOW} - interval '1 day' group by 1", lambda r: reports.error_trend(r, A.AS_OF, 1440))
_cr("retry_candidates", f"select domain, count(*) as failure_count, max(crawl_time) as last_failure, coalesce(array_to_string(list_sort(array_agg(distinct error_type) filter (where error_type is not null)), ','), '') as error_types from cr where not success and crawl_time > {NOW} - interval '720 hours' group by domain having count(*) >= 2 order by failure_count desc, domain limit 20", lambda r: reports.retry_candidates(r, A.AS_OF, 720, 2))
_cr("domain_detail", f"select success, error_type, count(*) as count, {AVG} as avg_response_time, max(crawl_time) as last_seen from cr where domain = 'd7.example.com' group by success, error_type", lambda r: reports.domain_detail(r, "d7.example.com"))
_cr("run_statistics", f"select count(*) as total, {OKN}::bigint as succeeded, round(avg(case when success then 1.0 else 0.0 end), 4) as success_rate, round(count(*) / 3600.0, 4) as requests_per_second, round(avg(response_time), 4) as avg_time from cr", lambda r: reports.run_statistics(r, 3600))
_cr("pool_statistics", f"select worker_id, count(*) as processed, {BADN}::bigint as failed, grouping(worker_id)::int as is_pool, round({BADN} / count(*)::double, 4) as error_rate from cr where worker_id is not null group by rollup (worker_id)", reports.pool_statistics)
_cr("index_totals", "select count(*) as n_rows, count(distinct domain) as n_domains from cr", reports.index_totals)


def _classify_sql() -> str:
    return """case when status_code = 403 then 'http_403_forbidden' when status_code = 404 then 'http_404_not_found' when status_code = 429 then 'http_429_rate_limit' when status_code between 500 and 599 then 'http_5xx_server_error'
 when contains(m, 'timeout') then 'timeout' when contains(m, 'ssl') or contains(m, 'certificate') then 'ssl_error' when contains(m, 'connect') or contains(m, 'refused') or contains(m, 'reset') then 'connection_error'
 when contains(m, 'dns') or contains(m, 'name resolution') or contains(m, 'getaddrinfo') or contains(m, 'nodename') then 'dns_error' when contains(m, 'robots') or contains(m, 'blocked') then 'robots_blocked'
 when contains(m, 'content') or contains(m, 'decode') or contains(m, 'encoding') or contains(m, 'charset') then 'content_error' else 'unknown' end"""


@query(f"with {CR}, k as (select id, {_classify_sql()} as kind from (select *, lower(coalesce(error_message, '')) as m from cr where not success)) select kind, count(*) as n, sum(case when kind in ('timeout','http_429_rate_limit','http_5xx_server_error','connection_error') then 1 else 0 end)::bigint as recoverable from k group by kind")
def crawl_error_kinds(spark, d):
    from .functions.scalars import crawl_error, recoverable

    k = A.crawl_results(spark, d).where("not success").select(crawl_error("error_message", "status_code").alias("kind"))
    return k.groupBy("kind").agg(F.count("*").alias("n"), F.count_if(recoverable("kind")).alias("recoverable"))


@query(f"with {CR} select id, case when m like '%timeout%' then 'timeout' when contains(m, 'ssl') then 'connection_error' else 'connection_error' end as kind from (select id, error_message as m from cr where not success)")
def fetch_error_kinds(spark, d):
    from .functions.scalars import fetch_error

    c = A.crawl_results(spark, d).where("not success")
    return c.select("id", fetch_error(F.when(F.col("error_message").contains("timeout"), "timeout").otherwise("connect"), "error_message").alias("kind"))


# --- stored pages, the older page table, the dead-letter table --------------------------------------------


@query(f"with {PAGES} select domain, count(*) as page_count, round(avg(static_score), 2) as avg_score, sum((processor = 'fast')::int)::bigint as fast_count, sum((processor = 'rich')::int)::bigint as rich_count from pg group by domain order by page_count desc, domain limit 100")
def top_domains(spark, d):
    return reports.top_domains(A.pages(spark, d))


HOURS = "select date_trunc('hour', crawled_at) as stat_hour, count(*) as total_processed, sum((processor = 'fast')::int)::bigint as fast_processed, sum((processor = 'rich')::int)::bigint as rich_processed, round(avg(static_score), 2) as avg_static_score, sum(raw_size_bytes)::bigint as total_raw_bytes, sum(markdown_size_bytes)::bigint as total_markdown_bytes, count(*) as total_crawled from pg group by 1"


@query(f"with {PAGES} {HOURS}")
def hourly_crawl_stats(spark, d):
    return reports.hourly_crawl_stats(A.pages(spark, d))


@query(f"with {PAGES}, h as ({HOURS}) select stat_hour, total_crawled, total_processed, fast_processed, rich_processed, {pct('fast_processed', 'total_processed')} as fast_ratio, avg_static_score, total_raw_bytes // 1024 // 1024 as total_raw_mb, total_markdown_bytes // 1024 // 1024 as total_markdown_mb from h")
def hourly_view(spark, d):
    return reports.hourly_view(reports.hourly_crawl_stats(A.pages(spark, d)))


@query(f"with {PAGES} select count(*) as total, sum((processor = 'fast')::int)::bigint as fast, sum((processor = 'rich')::int)::bigint as rich, sum((crawled_at > timestamp '2024-01-01 04:00:00' - interval '1 hour')::int)::bigint as last_hour, round(avg(static_score), 2) as avg_score from pg")
def stats_summary(spark, d):
    return reports.stats_summary(A.pages(spark, d), "2024-01-01 04:00:00")


@query(f"with {PAGES}, g as (select domain, processor, count(*) as n, sum(static_score) as s, max(crawled_at) as t from pg group by all) select domain, sum(n)::bigint as page_count, round(sum(s)::double / sum(n), 2) as avg_score, arg_min(processor, (-n, processor)) as dominant_processor, max(t) as last_crawled_at from g group by domain")
def domain_stats(spark, d):
    return reports.domain_stats(A.pages(spark, d))


@query(f"with {PAGES} select sum(raw_size_bytes)::bigint as original_bytes, sum(markdown_size_bytes)::bigint as kept_bytes, (sum(raw_size_bytes) - sum(markdown_size_bytes))::bigint as saved_bytes, round((sum(raw_size_bytes) - sum(markdown_size_bytes))::double / sum(raw_size_bytes), 4) as ratio from pg")
def size_statistics(spark, d):
    return reports.size_statistics(A.pages(spark, d))


@query(f"with {CRAWLED} select domain, count(*) as page_count, round(avg(length(content_text)), 2) as avg_content_length from cp group by domain")
def domain_lengths(spark, d):
    return reports.domain_lengths(A.crawled_pages(spark, d))


@query(f"with {CRAWLED} select count(*) as n from cp")
def total_pages(spark, d):
    return A.crawled_pages(spark, d).agg(F.count("*").alias("n"))


@query(f"with {CRAWLED}, r as (select * from cp where created_at > {NOW} - interval '24 hours') select (select count(*) from cp) as total_pages, count(case when created_at > {NOW} - interval '1 minute' then 1 end) as pages_last_1min, count(case when created_at > {NOW} - interval '5 minutes' then 1 end) as pages_last_5min, count(case when created_at > {NOW} - interval '1 hour' then 1 end) as pages_last_1hour, count(distinct domain) as unique_domains, round(coalesce(avg(length(content_text)), 0))::bigint as avg_content_length from r")
def crawler_stats(spark, d):
    return reports.crawler_stats(A.crawled_pages(spark, d), A.AS_OF)


@query(f"with {DLQ} select count(*) as dlq_total, count(case when created_at > {NOW} - interval '1 hour' then 1 end) as dlq_last_1hour, count(case when error_type = 'DataError' then 1 end) as dlq_data_errors, count(case when error_type = 'UniqueViolationError' then 1 end) as dlq_unique_errors from dlq")
def dlq_stats(spark, d):
    return reports.dlq_stats(A.crawler_dlq(spark, d), A.AS_OF)


@query("select 0::bigint as dlq_total, 0::bigint as dlq_last_1hour, 0::bigint as dlq_data_errors, 0::bigint as dlq_unique_errors", fixed=True)
def dlq_stats_missing(spark, d):
    return reports.dlq_stats_if_exists(spark, "crawler_dlq_that_is_not_there", A.AS_OF)


@query(f"with {CRAWLED} select count(case when created_at > {NOW} - interval '1 minute' then 1 end)::double / 60 as pages_per_second from cp")
def crawler_throughput(spark, d):
    return reports.throughput(A.crawled_pages(spark, d), A.AS_OF)


@query(f"with {CRAWLED}, g as (select domain, count(*) as n from cp where created_at > {NOW} - interval '24 hours' group by domain) select 'total' as metric_type, count(*)::bigint as domain_count from g union all select 'top_10_total', coalesce(sum(n), 0)::bigint from (select n from g order by n desc, domain limit 10)")
def domain_totals(spark, d):
    return reports.domain_totals(A.crawled_pages(spark, d), A.AS_OF)


@query(f"with {CRAWLED} select count(*) as estimated_total_pages, count(distinct case when created_at > {NOW} - interval '1 hour' then domain end) as unique_domains_1h from cp")
def total_stats(spark, d):
    return reports.total_stats(A.crawled_pages(spark, d), A.AS_OF)


@query(f"with {CRAWLED} select date_trunc('day', created_at) as start, count(*) as estimated_total, true as within_error from cp group by 1")
def estimated_totals(spark, d):
    """Rows and distinct domains of each day from hourly sketches, made in two batches and merged; whether the estimates are as near to the exact numbers as promised."""
    rows = A.crawled_pages(spark, d)
    odd = F.pmod(F.xxhash64("url"), F.lit(2)) == 1
    sketches = reports.merged_sketches(reports.hourly_sketches(rows.where(odd)), reports.hourly_sketches(rows.where(~odd)))
    exact = rows.groupBy(F.date_trunc("day", "created_at").alias("start")).agg(F.count_distinct("domain").alias("exact"))
    near = F.abs(F.col("estimated_distinct") - F.col("exact")) <= F.col("exact") * reports.SKETCH_ERROR + 1
    return reports.estimated_totals(sketches).join(exact, "start").select("start", "estimated_total", near.alias("within_error"))


# --- metrics ---------------------------------------------------------------------------------------------

SAMPLES = CR + ", g as (select time_bucket(interval '60 minutes', crawl_time) + interval '60 minutes' as ts, sum(success::int) as ok, sum((not success)::int) as bad from cr group by 1), l as (select ts, 'crawler_tasks_completed_total' as name, ok as n from g union all select ts, 'crawler_tasks_failed_total', bad from g), sm as (select ts, name, sum(n) over (partition by name order by ts)::double as value from l)"


def _samples(spark, d):
    return metrics.counter_samples(A.crawl_results(spark, d))


@query(f"with {SAMPLES} select name, arg_max(value, ts) as value from sm group by name")
def metric_instant(spark, d):
    return metrics.instant(_samples(spark, d), [])


RATE = "inc as (select name, ts, value - lag(value) over (partition by name order by ts) as i, epoch(ts) - epoch(lag(ts) over (partition by name order by ts)) as s from sm), rt as (select name, time_bucket(interval '360 minutes', ts) + interval '360 minutes' as ts, round(sum(i) / sum(s), 6) as rate from inc where i is not null group by 1, 2)"


@query(f"with {SAMPLES}, {RATE} select name, ts, rate from rt")
def metric_rate(spark, d):
    return metrics.rate(_samples(spark, d), [], "360 minutes")


@query(f"with {SAMPLES}, {RATE}, p as (select ts, sum(case when name like '%completed%' then rate end) as a, sum(case when name like '%failed%' then rate end) as b from rt group by ts) select ts, round(case when coalesce(a,0) + coalesce(b,0) <> 0 then coalesce(a,0) * 100.0 / (coalesce(a,0) + coalesce(b,0)) else 0 end, 4) as success_rate from p")
def metric_success_rate(spark, d):
    return metrics.success_rate(_samples(spark, d), "360 minutes")


_RISING = """s as (select event_type as name, ts, max(v)::double as v from (select event_type, ts, row_number() over (partition by event_type, date_trunc('day', ts) order by ts, event_id) as v from events where ts is not null) group by all),
 e as (select name, epoch_us(ts) as t, v, ceil(epoch_us(ts) / 60000000.0)::bigint + unnest(range(5)) as e from s), l as (select *, lag(v) over (partition by name, e order by t) as b from e),
 w as (select name, e * 60 as e, count(*) as n, arg_min(v, t) as fv, min(t) / 1e6 as ft, arg_max(v, t) as lv, max(t) / 1e6 as lt, sum(case when v < b then b else 0 end) as lost from l group by name, e having count(*) >= 2),
 g as (select *, lt - ft as span, (lt - ft) / (n - 1) as gap, lv - fv + lost as rise from w),
 r as (select *, least(case when ft - (e - 300) >= gap * 1.1 then gap / 2 else ft - (e - 300) end, case when rise > 0 and fv >= 0 then span * fv / rise end) as before, case when e - lt >= gap * 1.1 then gap / 2 else e - lt end as after from g),
 sr as (select name, make_timestamp(e::bigint * 1000000) as ts, rise * (span + before + after) / span / 300 as rate from r)"""


def _rising(spark, d):
    """A counter per kind of event, counting from zero every day, with a sample at each event."""
    from pyspark.sql import Window

    day = Window.partitionBy("event_type", F.date_trunc("day", "ts")).orderBy("ts", "event_id")
    e = A.table(spark, d, "events").where("ts is not null").select(F.col("event_type").alias("name"), "ts", F.row_number().over(day).alias("v"))
    return e.groupBy("name", "ts").agg(F.max("v").alias("value"))


@query(f"with {_RISING} select name, ts, round(rate, 6) as rate from sr")
def metric_sliding_rate(spark, d):
    """Rates over five minutes, every minute, with resets and extrapolation."""
    return metrics.sliding_rate(_rising(spark, d), []).withColumn("rate", F.round("rate", 6))


@query(f"with {_RISING} select ts, round(100 * a.rate / nullif(a.rate + b.rate, 0), 4) as success_rate from (select * from sr where name = 'view') a join (select * from sr where name = 'error') b using (ts)")
def metric_sliding_success(spark, d):
    return metrics.matched_success_rate(_rising(spark, d), "view", "error").withColumn("success_rate", F.round("success_rate", 4))


@query(f"with {CR} select time_bucket(interval '360 minutes', crawl_time) + interval '360 minutes' as ts, round(sum(response_time) / count(*), 6) as latency_avg from cr where response_time is not null group by 1")
def metric_latency_average(spark, d):
    return metrics.latency_average(A.crawl_results(spark, d), "360 minutes")


_EDGES = "(values (0.1::double, 0.0::double), (0.5, 0.1), (1.0, 0.5), (2.0, 1.0), (5.0, 2.0), (10.0, 5.0), (30.0, 10.0), (60.0, 30.0), ('inf'::double, 60.0)) e(le, le0)"
_HIST = f"hb as (select success, le, le0, count(*) filter (where response_time <= le) as n, count(*) filter (where response_time <= le0 and le0 > 0) as n0, count(*) as total from cr, {_EDGES} where response_time is not null group by success, le, le0)"


@query(f"with {CR}, {_HIST} select success, le, n::bigint as n from hb where le < 1000")
def metric_histogram(spark, d):
    return metrics.histogram(A.crawl_results(spark, d), ["success"]).where("le < 1000")


def _quantile(q: float):
    @query(f"with {CR}, {_HIST} select success, round(case when le > 1000 then le0 else le0 + (le - le0) * (total * {q} - n0) / (n - n0) end, 6) as quantile from hb where n >= total * {q} and n0 < total * {q}", f"metric_quantile_p{int(q * 100)}")
    def run(spark, d):
        return metrics.histogram_quantile(metrics.histogram(A.crawl_results(spark, d), ["success"]), q, ["success"])


for _q in (0.5, 0.95, 0.99):
    _quantile(_q)

_cr("metric_sum_by_error", "select error_type, count(*) as value from cr where not success group by error_type", lambda r: metrics.sum_by(r.where("not success"), "error_type"))
_cr("metric_sum_by_status", "select status_code, count(*) as value from cr group by status_code", lambda r: metrics.sum_by(r, "status_code"))
_cr("metric_topk_domains", "select domain, count(*) as value from cr where not success group by domain order by value desc, domain limit 10", metrics.topk_domains)
_cr("metric_errors_by_kind", "select count(*) filter (where error_type = 'timeout') as timeout, count(*) filter (where error_type = 'ssl_error') as ssl_error, count(*) filter (where error_type = 'dns_error') as dns_error, count(*) filter (where error_type = 'unknown') as unknown from cr where not success", lambda r: metrics.errors_by_kind(r, ("timeout", "ssl_error", "dns_error", "unknown")))
_cr("metric_domain_error_rate", "select domain, round(avg((not success)::int) * 100, 4) as error_rate, count(*) as requests from cr group by domain order by error_rate desc, requests desc, domain limit 10", metrics.domain_error_rate)
_cr("metric_recorded", "select name, label, sum(v)::bigint as value from (select 'crawl_requests_total' as name, case when success then 'success' else 'failed' end as label, 1 as v from cr union all select 'crawl_errors_total', coalesce(error_type, 'unknown'), 1 from cr where not success union all select 'crawl_http_status_total', status_code::varchar, 1 from cr where status_code is not null union all select 'domain_failures_total', domain, 1 from cr where not success union all select 'crawl_response_time_seconds_count', case when success then 'true' else 'false' end, 1 from cr where response_time is not null) group by all", metrics.record_results)


@query("select event_type as name, arg_max(value, ts) as latest, max(value) as max, min(value) as min, round(avg(value), 6) as avg, count(*) as count from events where not isnan(value) group by event_type")
def metric_range_summary(spark, d):
    return metrics.range_summary(A.table(spark, d, "events").select("ts", F.col("event_type").alias("name"), "value"))


# --- vectors, chunks -------------------------------------------------------------------------------------


def _query_vector(spark, d) -> list[float]:
    return [float(x) for x in A.table(spark, d, "embeddings").where("vec_id = 7").first().embedding]


_SIM = "list_cosine_similarity(embedding::double[], (select embedding::double[] from embeddings where vec_id = 7))"


@query(f"with {CHUNKS}, {PAGES} select c.url, c.chunk_index, round({_SIM}, 4) as similarity, pg.domain, pg.title, c.heading_ctx, c.chunk_text from ch c left join pg on pg.url = c.url where {_SIM} >= 0.1 order by {_SIM} desc, c.url, c.chunk_index limit 20")
def vector_search(spark, d):
    from .operators import search

    found = search.search(A.page_chunks(spark, d), A.pages(spark, d), _query_vector(spark, d), 20, 0.1)
    return found.select("url", "chunk_index", "similarity", "domain", "title", "heading_ctx", "chunk_text")


@query(f"with {CHUNKS}, {PAGES} select c.url, c.chunk_index, round({_SIM}, 4) as similarity, pg.domain from ch c join pg on pg.url = c.url where {_SIM} >= -1 and pg.domain = (select domain from pg where id = 7) order by {_SIM} desc, c.url, c.chunk_index limit 5")
def vector_search_domain(spark, d):
    from .operators import search

    pages = A.pages(spark, d)
    domain = pages.where("id = 7").first().domain
    return search.search(A.page_chunks(spark, d), pages, _query_vector(spark, d), 5, -1.0, domain).select("url", "chunk_index", "similarity", "domain")


@query(f"with {CHUNKS}, {PAGES} select c.id, c.url, c.chunk_index, pg.title, pg.domain, pg.language, pg.crawled_at from ch c left join pg on pg.url = c.url where c.embedding is not null")
def chunk_search_view(spark, d):
    from .operators import search

    return search.search_view(A.page_chunks(spark, d), A.pages(spark, d)).select("id", "url", "chunk_index", "title", "domain", "language", "crawled_at")


@query(f"with {CHUNKS}, {PAGES} select c.url, pg.title, pg.domain, c.chunk_index, c.chunk_text, c.heading_ctx from ch c left join pg on pg.url = c.url where c.url = (select url from pages where page_id = 7)")
def chunks_of_page(spark, d):
    from .operators import search

    return search.chunks_of(A.page_chunks(spark, d), A.pages(spark, d), A.raw_pages(spark, d).where("page_id = 7").first().url)


@query(f"with {CHUNKS} select count(distinct url) as urls_embedded, count(*) as total_chunks, avg(len(embedding)) as avg_dimension, min(created_at) as first_created, max(created_at) as last_created, round(count(*)::double / count(distinct url), 2) as avg_chunks_per_url from ch where embedding is not null")
def embedding_stats(spark, d):
    return reports.embedding_stats(A.page_chunks(spark, d))


@query(f"with {CHUNKS} select c.id, c.url, p.page_id from ch c left join pages p on p.url = c.url")
def backfill_page_ids(spark, d):
    from .operators import merge

    chunks = A.page_chunks(spark, d).withColumn("page_id", F.lit(None).cast("long"))
    pages = A.raw_pages(spark, d).select("url", F.col("page_id").alias("id"))
    return merge.backfill_page_ids(chunks, pages).select("id", "url", "page_id")


_TOP20 = f"{CHUNKS}, {PAGES}, top as (select c.url, c.chunk_index, round({_SIM}, 4) as similarity, pg.domain, pg.title, c.heading_ctx, c.chunk_text from ch c left join pg on pg.url = c.url where {_SIM} >= 0.1 order by {_SIM} desc, c.url, c.chunk_index limit 20)"


@query(f"""with {_TOP20}, rk as (select *, row_number() over (order by similarity desc, url, chunk_index) as rank from top),
 h as (select *, '[' || rank || '] ' || coalesce(nullif(title, ''), '제목 없음') || ' (' || coalesce(domain, '') || ')' || chr(10) || 'URL: ' || url || chr(10) || '위치: ' || case when coalesce(heading_ctx, '') <> '' then heading_ctx || ' ' else '' end || '(유사도: ' || printf('%.2f', similarity) || ')' as header from rk),
 u as (select *, header || chr(10) || chr(10) || chunk_text as section from h), v as (select *, sum(length(section)) over (order by rank) as upto from u),
 w as (select *, 4000 - (upto - length(section)) - length(header) - 10 as room, (select min(rank) from v where upto > 4000) as over_at from v)
 select coalesce(string_agg(case when rank = over_at then header || chr(10) || chr(10) || left(chunk_text, room::bigint) || '...' else section end, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by rank), '관련 문서를 찾을 수 없습니다.') as context
 from w where over_at is null or rank < over_at or (rank = over_at and room > 100)""")
def search_context(spark, d):
    from .operators import search

    return search.format_context(search.search(A.page_chunks(spark, d), A.pages(spark, d), _query_vector(spark, d), 20, 0.1))


def _probed(spark, d, lists: int, probes: int, k: int) -> DataFrame:
    from .operators import search

    chunks, q = A.page_chunks(spark, d), _query_vector(spark, d)
    centres = search.learn_centres(chunks, lists)
    return search.search(search.probe(search.assign_lists(chunks, centres), centres, q, probes), A.pages(spark, d), q, k, 0.1).select("url", "chunk_index", "similarity")


@query()
def vector_search_probed(spark, d):
    """An inverted file of eight lists, three of them probed; its recall is measured in the tests."""
    return _probed(spark, d, 8, 3, 5)


@query(f"with {_TOP20} select url, chunk_index, similarity from top")
def vector_search_all_lists(spark, d):
    """With every list probed the inverted file gives the exact result."""
    return _probed(spark, d, 8, 8, 20)


# --- scalar functions, URLs, HTML, chunker ---------------------------------------------------------------


def _fold_sql(domain: str, n: int) -> str:
    out = "0::bigint"
    for i in range(1, 33, 4):
        out = f"(({out}) * 65536 + ('0x' || substr(md5({domain}), {i}, 4))::bigint) % {n}"
    return out


_NET = "regexp_extract(url, '^(?:[^:/?#]+:)?//([^/?#]*)', 1)"


@query(f"select page_id, {_NET} as netloc, coalesce(nullif(regexp_extract(url, '^(?:[^:/?#]+:)?//[^/?#]*([^?#]*)', 1), ''), '/') as path, {_NET} || '/' || {_KEY} || '.html' as object_key, md5(url) as url_hash, {_fold_sql(_NET, 7)} as shard, substr(md5(url), 1, 8) as session_id, 'https://' || {_NET} || '/' as domain_url from pages")
def url_functions(spark, d):
    from .functions import scalars as S

    n = S.netloc("url")
    return A.raw_pages(spark, d).select("page_id", n.alias("netloc"), S.path_of("url").alias("path"), S.object_key("url", "html").alias("object_key"), S.url_hash("url").alias("url_hash"), S.shard_of_domain(n, 7).cast("long").alias("shard"), S.session_id("url").alias("session_id"), S.domain_url(n).alias("domain_url"))


@query("select doc_id, array_to_string(list_transform(string_split(text, ','), lambda x: trim(x, ' '))[1:5], '|') as keywords, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') as ascii_text, trim(regexp_replace(text, '\\s+', ' ', 'g')) as collapsed, case when doc_id % 3 <> 0 then to_timestamp(1700000000 + doc_id)::timestamp end as at, left(text, 10) as cut from documents")
def text_functions(spark, d):
    """Keywords, ASCII letters and collapsed white space of whole texts; ``cut`` is the function that shortens."""
    from .functions import scalars as S

    t = A.table(spark, d, "documents")
    at = S.epoch_to_time(F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") + 1700000000).otherwise(0))
    return t.select("doc_id", F.array_join(S.keywords("text", 5), "|").alias("keywords"), S.ascii_only("text").alias("ascii_text"), S.collapse("text").alias("collapsed"), at.alias("at"), F.substring("text", 1, 10).alias("cut"))


_ROBOTS = "case event_id % 5 when 0 then 'User-agent: *' when 1 then 'Crawl-Delay: ' || event_id % 50 when 2 then 'request-rate: 1/' || event_id % 40 when 3 then 'crawl-delay: 2.5 visit-time: ' || event_id % 9 else null end"


@query(f"with r as (select event_id, lower(coalesce({_ROBOTS}, '')) as t from events) select event_id, greatest(least(coalesce(nullif(regexp_extract(t, 'crawl-delay:\\s*(\\d+\\.?\\d*)', 1), '')::double, 1.0), 30), least(coalesce(nullif(regexp_extract(t, 'request-rate:\\s*1/(\\d+)', 1), '')::double, 0), 30), least(coalesce(nullif(regexp_extract(t, 'visit-time:\\s*(\\d+)', 1), '')::double, 0), 30)) as delay from r")
def robots_delay(spark, d):
    from .functions.scalars import crawl_delay

    return A.table(spark, d, "events").select("event_id", crawl_delay(F.expr(_ROBOTS)).alias("delay"))


@query("select event_id, case when event_id <= 100 then 1000 when event_id <= 1000 then 900 when event_id <= 10000 then 800 when event_id <= 100000 then 700 else 600 end as priority, case when event_id % 9 = 0 then 'priority_custom' when event_id <= 1000 then 'priority_high' when event_id <= 10000 then 'priority_medium' when event_id <= 100000 then 'priority_normal' else 'priority_low' end as queue, (event_id % 300 > 100 and (event_id % 7) * 20.0 / nullif(event_id % 300, 0) > 0.5) or event_id % 100 > 90 as restart from events")
def priorities(spark, d):
    from .functions import scalars as S

    n = F.col("event_id")
    p = S.rank_priority(n)
    return A.table(spark, d, "events").select("event_id", p.alias("priority"), S.queue_of(p, F.when(n % 9 == 0, "custom").otherwise("root")).alias("queue"), S.restart_needed(n % 300, (n % 7) * 20.0, n % 100).alias("restart"))


@query(r"""with p as (select page_id, regexp_extract(url, '^(https?)://', 1) as scheme, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) as host, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) as path, regexp_extract(url, '[?]([^#]*)', 1) as q from pages),
 k as (select *, array_to_string(list_filter(string_split(q, '&'), lambda x: split_part(x, '=', 2) <> '' and not starts_with(lower(x), 'utm_') and lower(split_part(x, '=', 1)) not in ('ref', 'referrer', 'source', 'fbclid', 'gclid')), '&') as kept from p)
 select page_id, scheme || '://' || host || coalesce(nullif(path, ''), '/') || case when kept = '' then '' else '?' || kept end as url from k""")
def normalised_urls(spark, d):
    from .functions.urls import normalise

    return A.raw_pages(spark, d).select("page_id", normalise("url").alias("url"))


@query(f"select page_id, 'https://' || lower({_NET}) || regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) as seed from pages")
def normalised_seeds(spark, d):
    """Seeds without a scheme, from the pages' URLs."""
    from .functions.urls import normalise_seed

    return A.raw_pages(spark, d).select("page_id", normalise_seed(F.regexp_replace("url", "^https?://", "  ")).alias("seed"))


@query(f"select page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/a/b?c=' || page_id as link from pages")
def absolute_links(spark, d):
    from .functions.urls import absolute

    return A.raw_pages(spark, d).select("page_id", absolute("url", F.concat(F.lit("/a/x/../b?c="), "page_id")).alias("link"))


@query("select page_id, url as text from pages")
def compressed_round_trip(spark, d):
    from .sources.readers import compress, decompress

    return A.raw_pages(spark, d).select("page_id", decompress(compress("url")).alias("text"))


def _plain(c: str) -> str:
    """SQL of a text without the entities that the pages hold."""
    for entity, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        c = f"replace({c}, '{entity}', '{char}')"
    return c


def _strings(c: str, glue: str = " ") -> str:
    """SQL of the stripped strings between tags."""
    blank = "' ' || chr(9) || chr(10) || chr(13)"
    return _plain(f"array_to_string(list_filter(list_transform(regexp_split_to_array({c}, '<[^>]*>'), lambda x: trim(x, {blank})), lambda x: x <> ''), '{glue}')")


def _without(c: str, *patterns: str) -> str:
    for p in patterns:
        c = f"regexp_replace({c}, '{p}', '', 'gs')"
    return c


_TITLE = _plain("regexp_extract(html, '<title>([^<]*)</title>', 1)")
_LANG = "regexp_extract(html, '<html lang=\"([^\"]*)\"', 1)"
_ARTICLE = _strings("regexp_extract(html, '<article>(.*?)</article>', 1, 's')")
_BODY = _strings(_without("regexp_extract(html, '<body>(.*)', 1, 's')", "<nav>.*?</nav>", "<footer>.*?</footer>", "<!--.*?-->"))
_FAST = "route = 'fast'"


@query(f"""with {SCORED} select page_id, true as success, route as processor_type, case when {_FAST} then left(trim({_TITLE}), 200) else {_TITLE} end as title, case when {_FAST} then left({_LANG}, 10) end as language,
 case when {_FAST} then 'H1: ' || left(trim({_plain("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")}), 100) else '' end as headings, 0 as n_links, 0 as n_images, left(case when {_FAST} then {_ARTICLE} else {_BODY} end, 10000) as plain_text, length(html)::int as content_length from s""")
def extracted_pages(spark, d):
    """Both routes' extraction of all pages, but for Markdown; their links all stand in navigation, which goes."""
    from . import api

    x, p = F.col("extracted"), api.process(A.raw_pages(spark, d))
    return p.select("page_id", "success", "processor_type", x["title"].alias("title"), x["language"].alias("language"), F.array_join(x["headings"], "|").alias("headings"), F.size(x["links"]).alias("n_links"), F.size(x["images"]).alias("n_images"), x["plain_text"].alias("plain_text"), x["content_length"].alias("content_length"))


@query(f"select page_id, trim({_TITLE}) as title, {_LANG} as language, null::varchar as description, null::varchar as author, null::varchar as canonical_url, '' as keywords from pages")
def page_metadata(spark, d):
    from .functions.html import metadata

    m = A.raw_pages(spark, d).select("page_id", metadata("html").alias("m"))
    return m.select("page_id", "m.title", "m.language", "m.description", "m.author", "m.canonical_url", F.array_join("m.keywords", ",").alias("keywords"))


@query(f"""with t as (select *, {_without("html", "<script>.*?</script>", "<style>.*?</style>", "<!--.*?-->", "<!DOCTYPE[^>]*>")} as h from pages)
 select page_id, trim({_TITLE}) as title, trim(regexp_replace({_plain("array_to_string(regexp_split_to_array(h, '<[^>]*>'), ' ')")}, '\\s+', ' ', 'g')) as content_text,
 '{{"content_length": ' || length(html) || ', "url_path": "' || regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) || '"}}' as metadata from t""")
def legacy_extraction(spark, d):
    from .functions.html import legacy

    return A.raw_pages(spark, d).select("page_id", legacy("html", "url").alias("m")).select("page_id", "m.*")


_LINKED = _without("html", "<nav>.*?</nav>", "<footer>.*?</footer>", "<!--.*?-->")


@query(f"""with h as (select url, list_filter(regexp_extract_all({_LINKED}, '<a [^>]*href="(/[^"]*)"', 1), lambda x: x <> '') as hrefs from pages)
 select url as source_url, 1 as current_depth, (generate_subscripts(hrefs, 1) - 1)::int as position, regexp_extract(url, '^(https?://[^/?#]+)', 1) || unnest(hrefs) as url from h""")
def discovered_links(spark, d):
    """Links of all pages outside of navigation, as they go to the frontier."""
    from . import api
    from .streaming.pipeline import discovered

    return discovered(api.process(A.raw_pages(spark, d)))


@query(r"""with t as (select doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) as body from documents where length(text) >= 200),
 p as (select doc_id, body, list_filter(list_transform(string_split(regexp_replace(body, '\n\n+', chr(2), 'g'), chr(2)), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13))), lambda x: x <> '') as parts from t where body <> ''),
 g as (select doc_id, case when length(body) <= 500 then body else list_reduce(parts, lambda a, x: case when length(string_split(a, chr(1))[-1]) + 2 + length(x) <= 500 then a || chr(10) || chr(10) || x else a || chr(1) || x end) end as pieces from p),
 s as (select doc_id, list_transform(string_split(pieces, chr(1)), lambda y: case when length(y) <= 500 then y else list_reduce(string_split(regexp_replace(y, '([.!?])\s+', '\1' || chr(2), 'g'), chr(2)), lambda a, x: case when length(string_split(a, chr(1))[-1]) + 1 + length(x) <= 500 then a || ' ' || x else a || chr(1) || x end) end) as pieces from g),
 c as (select doc_id, flatten(list_transform(string_split(array_to_string(pieces, chr(1)), chr(1)), lambda y: list_transform(range(0, length(y), 500), lambda k: y[k + 1:k + 500]))) as pieces from s),
 m as (select doc_id, string_split(list_reduce(pieces, lambda a, x: case when length(string_split(a, chr(1))[-1]) < 50 then a || chr(10) || chr(10) || x else a || chr(1) || x end), chr(1)) as pieces from c),
 f as (select doc_id, case when len(pieces) > 1 and length(pieces[-1]) < 50 then list_append(pieces[1:-3], pieces[-2] || chr(10) || chr(10) || pieces[-1]) else pieces end as pieces from m)
 select 'doc:' || doc_id as url, unnest(range(0, len(pieces)))::int as chunk_index, trim(unnest(pieces), ' ' || chr(9) || chr(10) || chr(13)) as chunk_text, '' as heading_ctx from f""")
def document_chunks(spark, d):
    """All chunks of the documents, which have no headings."""
    from .functions.chunking import chunk_rows

    docs = A.table(spark, d, "documents").select(F.concat(F.lit("doc:"), "doc_id").alias("url"), F.col("text").alias("markdown"))
    return chunk_rows(docs, most_chunks=None)


@query()
def chunk_vectors(spark, d):
    from . import api

    return api.embed(api.process(A.raw_pages(spark, d)))


# --- frontier --------------------------------------------------------------------------------------------

FOUND = CR + ", u as (select 'https://' || domain || '/p/' || id % 40 as url, domain, id as arrival from (select id, 'd' || id % 23 || '.example.com' as domain from cr)), dn as (select distinct url from u where arrival % 17 = 0), wt as (select distinct url from u where arrival % 19 = 0)"


def _found(spark, d):
    u = A.crawl_results(spark, d).withColumn("domain", F.concat(F.lit("d"), F.col("id") % 23, F.lit(".example.com")))
    u = u.select(F.concat(F.lit("https://"), "domain", F.lit("/p/"), F.col("id") % 40).alias("url"), F.col("id").alias("arrival"), F.lit("seed").alias("source_url"))
    h = F.md5(F.col("url").cast("binary")).alias("url_hash")
    return u, u.where("arrival % 17 = 0").select(h), u.where("arrival % 19 = 0").select(h)


@query(f"with {FOUND}, k as (select u.*, dn.url is not null as a, wt.url is not null as b from u left join dn using (url) left join wt using (url)), o as (select *, case when a then 'dedup_completed' when b or row_number() over (partition by url order by arrival) > 1 then 'dedup_pending' end as outcome from k), c as (select *, case when outcome is null and row_number() over (partition by domain, outcome is null order by arrival) > 9 then 'domain_limit' else coalesce(outcome, 'added') end as final from o) select url, arrival, final as outcome from c")
def discovered_outcomes(spark, d):
    from .operators import frontier

    u, done, wait = _found(spark, d)
    return frontier.add_discovered(u, done, wait, 3, most=9).select("url", "arrival", "outcome")


_SCOPED = "o as (select u.*, case when row_number() over (partition by url order by arrival) > 1 then 'dedup_pending' when domain <> 'd3.example.com' or not starts_with('/p/' || arrival % 40, '/p/1') then 'scope_filtered' when arrival % 5 > 3 then 'scope_depth_limit' end as outcome from u)"


@query(f"with {FOUND}, {_SCOPED}, c as (select *, case when outcome is null and row_number() over (partition by outcome is null order by arrival) > 4 then 'scope_page_limit' else coalesce(outcome, 'added') end as final from o), z as (select *, row_number() over (partition by final = 'added' order by arrival) as k from c) select url, arrival, final as outcome, case when final = 'added' then (arrival % 5)::bigint end as depth, case when final = 'added' then k end as pages from z")
def scoped_outcomes(spark, d):
    from .operators import frontier

    u, done, _ = _found(spark, d)
    scope = F.struct(F.lit("https://d3.example.com/").alias("seed_url"), F.lit("d3.example.com").alias("allowed_domain"), F.lit("/p/1").alias("path_prefix"), F.lit(3).alias("max_depth"), F.lit(4).alias("max_pages"))
    none = done.where("false")
    out, added = frontier.add_scoped(u.withColumn("scope", scope).withColumn("current_depth", F.col("arrival") % 5), none, none, 3), F.col("outcome") == "added"
    return out.select("url", "arrival", "outcome", F.when(added, F.col("scope.current_depth")).alias("depth"), F.when(added, F.col("scope.pages_crawled").cast("long")).alias("pages"))


QUEUES = CR + ", qs as (select id, (id % 3)::int as shard, 'https://q/' || id as url, case when id % 11 = 0 then 'priority_custom' when id <= 1000 then 'priority_high' when id <= 3000 then 'priority_medium' when id <= 6000 then 'priority_normal' else 'priority_low' end as queue, (1000 - id % 97)::int as priority from cr where id % 2 = 0), st as (select (id % 3)::int as shard, domain, case id % 10 when 1 then 'processing' when 3 then 'failed' else 'completed' end as state from cr where id % 2 = 1)"


def _queues(spark, d):
    n = F.col("id")
    c = A.crawl_results(spark, d)
    queue = F.when(n % 11 == 0, "priority_custom").when(n <= 1000, "priority_high").when(n <= 3000, "priority_medium").when(n <= 6000, "priority_normal").otherwise("priority_low")
    q = c.where("id % 2 = 0").select(n, (n % 3).cast("int").alias("shard"), F.concat(F.lit("https://q/"), n).alias("url"), queue.alias("queue"), (1000 - n % 97).cast("int").alias("priority"))
    s = c.where("id % 2 = 1").select((n % 3).cast("int").alias("shard"), "domain", F.when(n % 10 == 1, "processing").when(n % 10 == 3, "failed").otherwise("completed").alias("state"))
    return q, s


_Q = ("priority_high", "priority_custom", "priority_medium", "priority_normal", "priority_low")
_QRANK = "list_position(['" + "','".join(_Q) + "'], queue)"
_QCOLS = ", ".join(f"sum((what = '{x}')::int)::bigint as {x}" for x in (*_Q, "processing", "completed", "failed"))


@query(f"with {QUEUES}, l as (select shard, queue as what from qs union all select shard, state from st), g as (select shard, {_QCOLS} from l group by shard union all select null, {_QCOLS} from l) select *, {' + '.join(_Q)} as total_pending, round(completed * 100.0 / (completed + failed), 2) as success_rate from g")
def queue_stats(spark, d):
    from .operators import frontier

    return frontier.queue_stats(*_queues(spark, d))


@query(f"with {QUEUES} select shard, count(*) as load from (select shard from qs union all select shard from st where state = 'processing') group by shard")
def shard_loads(spark, d):
    from .operators import frontier

    q, s = _queues(spark, d)
    return frontier.shard_loads(q, s.where("state = 'processing'"), 3)


@query(f"with {QUEUES}, g as (select domain, sum((state = 'completed')::int)::bigint as success, sum((state = 'failed')::int)::bigint as failed from st group by domain) select *, success + failed as total, round(case when success + failed > 0 then success * 100.0 / (success + failed) else 0 end, 2) as success_rate from g order by total desc, domain limit 20")
def domain_summary(spark, d):
    from .operators import frontier

    return frontier.domain_summary(_queues(spark, d)[1])


@query(f"with {QUEUES}, b as (select *, row_number() over (partition by shard, queue order by priority desc, url desc) as r from qs), k as (select url, shard, row_number() over (order by list_position([1, 2, 0], shard), {_QRANK}, r) as position from b where r <= 20) select url, shard, position from k where position <= 150")
def next_batch(spark, d):
    """Three shards in the order that the seed gives, each queue with its best few."""
    from .operators import frontier

    return frontier.next_batch(_queues(spark, d)[0], 150).select("url", "shard", F.col("position").cast("long"))


@query(f"with {QUEUES} select url from qs order by {_QRANK}, priority desc, url desc limit 30")
def next_unsharded(spark, d):
    from .operators import frontier

    return frontier.next_unsharded(_queues(spark, d)[0], 30).select("url")


@query(f"with {QUEUES} select url, 500 as priority from qs where id <= 900 order by id, url limit 20")
def due_retries(spark, d):
    from .operators import frontier

    return frontier.due_retries(_queues(spark, d)[0].withColumn("due", F.col("id").cast("double")), 900.0).select("url", "priority")


@query(f"with r as (select page_id + 1 as rank, {_NET} as domain from pages), p as (select *, case when rank <= 100 then 1000 when rank <= 1000 then 900 when rank <= 10000 then 800 when rank <= 100000 then 700 else 600 end as priority from r) select rank, domain, 'https://' || domain || '/' as url, priority, case when priority >= 900 then 'priority_high' when priority >= 800 then 'priority_medium' when priority >= 700 then 'priority_normal' else 'priority_low' end as queue from p")
def prepared_queue(spark, d):
    from .functions.scalars import netloc
    from .operators import frontier

    ranks = A.raw_pages(spark, d).select((F.col("page_id") + 1).alias("rank"), netloc("url").alias("domain"))
    return frontier.prepare(ranks, 3).select("rank", "domain", "url", "priority", "queue")


@query(f"""with {QUEUES}, q as (select id, url, queue, priority, case when shard = 1 or (shard = 2 and id % 100 <> 2) then 0 else shard end as shard from qs),
 l as (select s.shard, count(q.url) as load from (values (0), (1), (2)) s(shard) left join q on q.shard = s.shard group by s.shard), m as (select avg(load) as mean, arg_min(shard, (load, shard)) as least, min(load) as low from l),
 c as (select q.*, least, row_number() over (partition by q.shard, queue order by priority, url) as r, least(10, count(*) filter (where queue = 'priority_low') over (partition by q.shard)) as n_low from q join l on l.shard = q.shard, m where load > mean * 1.5 and low < mean * 0.5 and queue in ('priority_low', 'priority_normal'))
 select url, queue, least::int as shard from c where (queue = 'priority_low' and r <= n_low) or (queue = 'priority_normal' and r <= least(10, 25 - n_low))""")
def rebalanced(spark, d):
    """Rows that move when almost all of three shards' queues stand in one of them."""
    from .operators import frontier

    q, s = _queues(spark, d)
    q = q.withColumn("shard", F.when((F.col("shard") == 1) | ((F.col("shard") == 2) & (F.col("id") % 100 != 2)), 0).otherwise(F.col("shard")))
    return frontier.rebalance(q, s.where("false"), 3).where("moved").select("url", "queue", "shard")


# --- upserts ---------------------------------------------------------------------------------------------

UPS = PAGES + ", t as (select url, domain, title, static_score, crawled_at, version from (select *, 3 as version from pg where id % 2 = 0)), ar as (select url, 'x' as domain, 'new' || k as title, static_score + k as static_score, crawled_at + to_days(k) as crawled_at, k as processed_at from pg, (values (1), (2)) v(k) where id % 2 = 1 or id % 3 = 0), n as (select url, arg_max(title, processed_at) as title, arg_max(static_score, processed_at) as static_score, arg_min(domain, processed_at) as domain, arg_min(crawled_at, processed_at) as crawled_at, count(*) as k from ar group by url)"


@query(f"with {UPS} select coalesce(t.url, n.url) as url, coalesce(t.domain, n.domain) as domain, coalesce(n.title, t.title) as title, coalesce(n.static_score, t.static_score) as static_score, coalesce(t.crawled_at, n.crawled_at) as crawled_at, (coalesce(t.version, 0) + coalesce(n.k, 0))::int as version from t full join n on t.url = n.url")
def upserted_pages(spark, d):
    from .operators import merge

    p = A.pages(spark, d)
    target = p.where("id % 2 = 0").select("url", "domain", "title", "static_score", "crawled_at", F.lit(3).alias("version"))
    k = F.explode(F.array(F.lit(1), F.lit(2)))
    batch = p.where("id % 2 = 1 or id % 3 = 0").withColumn("k", k).select("url", F.lit("x").alias("domain"), F.concat(F.lit("new"), "k").alias("title"), (F.col("static_score") + F.col("k")).alias("static_score"), (F.col("crawled_at") + F.make_dt_interval(F.col("k"))).alias("crawled_at"), F.col("k").alias("processed_at"))
    return merge.upsert_pages(target, batch)


@query(f"with {CHUNKS}, n as (select url, chunk_index, 'fresh' as chunk_text from ch where id % 5 = 0 and url is not null) select ch.url, ch.chunk_index, coalesce(n.chunk_text, ch.chunk_text) as chunk_text from ch left join n using (url, chunk_index) where ch.url is not null")
def upserted_chunks(spark, d):
    from .operators import merge

    c = A.page_chunks(spark, d).where("url is not null")
    target = c.select("url", "chunk_index", "chunk_text", "created_at")
    return merge.upsert_chunks(target, target.where(F.regexp_extract("chunk_text", r"(\d+)", 1).cast("int") % 5 == 0).withColumn("chunk_text", F.lit("fresh"))).select("url", "chunk_index", "chunk_text")


@query(f"with {CR}, a as (select domain as url, arg_min(id, crawl_time) as first_id from cr group by domain) select url, first_id from a")
def first_arrivals(spark, d):
    from .operators import merge

    return merge.first_by_url(A.crawl_results(spark, d).select(F.col("domain").alias("url"), "id", "crawl_time"), "crawl_time").select("url", F.col("id").alias("first_id"))


@query(f"""with {CR} select url, error_message, error_type, '{{"id":' || id || ',"url":"' || url || '","shard_id":' || shard_id || coalesce(',"status_code":' || status_code, '') || coalesce(',"error_type":"' || error_type || '"', '') || coalesce(',"error_message":"' || error_message || '"', '') || '}}' as raw_data from cr where not success and worker_id is null""")
def dead_letters(spark, d):
    """Failures without a worker; their records as JSON leave out what is null."""
    from .operators import merge

    _, bad = merge.split_valid(A.crawl_results(spark, d).where("not success"), ("worker_id",))
    bad = bad.select("id", "url", "shard_id", "status_code", "error_type", "error_message")
    return merge.dead_letters(bad, F.col("error_type"), F.col("error_message"), F.lit(0)).select("url", "error_message", "error_type", "raw_data")


@query(f"with {CR} select domain, id from cr qualify row_number() over (partition by domain order by crawl_time desc) <= 2")
def last_history(spark, d):
    from .operators import merge

    return merge.last_n(A.crawl_results(spark, d), "domain", "crawl_time", 2).select("domain", "id")


@query(f"""with {SCORED} select url, coalesce(nullif(domain, ''), 'unknown') as domain, case when {_FAST} then left(trim({_TITLE}), 200) else {_TITLE} end as title, null::varchar as description, case when {_FAST} then left({_LANG}, 10) end as language, '' as keywords, route as processor, score as static_score,
 case when score >= 80 then 'Score ' || score || ' >= 80: Static page, suitable for BeautifulSoup' else 'Score ' || score || ' < 80: Dynamic page, requires Crawl4AI' end as route_reason, domain || '/' || {_KEY} || '.html' as raw_html_key, domain || '/' || {_KEY} || '.md' as markdown_key,
 length(html)::bigint as raw_size_bytes, 200 as status_code, 'text/html' as content_type, to_timestamp(1700000000 + page_id)::timestamp as crawled_at, to_timestamp(1700000001 + page_id)::timestamp as processed_at from s""")
def stored_pages(spark, d):
    """Page rows of the processed pages, but for the length of their Markdown."""
    from . import api
    from .operators import merge

    p = api.process(A.raw_pages(spark, d)).withColumns({"status_code": F.lit(200), "content_type": F.lit("text/html"), "original_timestamp": F.col("page_id") + 1.7e9, "processor_timestamp": F.col("page_id") + 1.7e9 + 1})
    return merge.page_records(p).withColumn("keywords", F.array_join("keywords", ",")).drop("markdown_size_bytes")


# --- streams ---------------------------------------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    import uuid

    from .sources.readers import shared_folder

    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    path = f"{d.rstrip('/')}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).option("pathGlobFilter", "*.parquet").parquet(f"{d.rstrip('/')}/{name}.parquet*")


@query("select date_trunc('hour', ts) as stat_hour, count(*) as total_processed, sum((event_type <> 'error')::int)::bigint as fast_processed, sum((event_type = 'error')::int)::bigint as rich_processed from events group by 1")
def stream_hourly_counters(spark, d):
    """Hourly counters of a stream, which equal those of the whole table."""
    from .streaming.pipeline import hourly_counters

    e = _stream(spark, d, "events").select(F.col("ts").cast("timestamp").alias("processed_at"), F.when(F.col("event_type") == "error", "rich").otherwise("fast").alias("processor"))
    out = _folder(spark, "hourly")
    q = hourly_counters(e).writeStream.outputMode("complete").option("checkpointLocation", out + "/c").foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(out + "/t")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out + "/t")


@query(f"with {SCORED} select page_id, score, route from s")
def stream_routes(spark, d):
    """Pages routed by a stream into two topics, read together."""
    from .streaming.pipeline import start_router

    out = _folder(spark, "router")
    start_router(_stream(spark, d, "pages"), out + "/t", out + "/c").awaitTermination()
    read = [spark.read.parquet(f"{out}/t/process.{k}") for k in ("fast", "rich")]
    return read[0].unionByName(read[1]).select("page_id", "score", "route")


@query("select 'd' || event_id % 23 as key, event_id::varchar as url, case when row_number() over (partition by event_id % 23 order by event_id) <= 100 then 'added' else 'domain_limit' end as outcome from events")
def stream_domain_cap(spark, d):
    """A cap per domain over a whole stream, with one counter of state a domain."""
    from .streaming.pipeline import cap_per_key

    e = _stream(spark, d, "events").select(F.concat(F.lit("d"), F.col("event_id") % 23).alias("domain"), F.col("event_id").cast("string").alias("url"), F.col("event_id").alias("arrival"))
    out = _folder(spark, "cap")
    q = cap_per_key(e, "domain", 100).writeStream.outputMode("append").option("checkpointLocation", out + "/c").foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/t/batch={i}")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out + "/t").select("key", "url", "outcome")


@query(f"with {CR} select id, crawl_time, 1000.0::double + 30 * 60 as due from cr where not success and error_type in ('timeout', 'connection_error')")
def retry_due(spark, d):
    from .streaming.pipeline import retry_times

    return retry_times(A.crawl_results(spark, d).where("not success"), 1000.0).select("id", "crawl_time", "due")


_cr("crawl_summary", f"select count(distinct domain) as domains, count(*) as pages, {BADN}::bigint as errors, round({BADN} / count(*)::double, 4) as error_rate, round(avg(response_time), 4) as avg_delay from cr", reports.crawl_summary)
_cr("shard_dashboard", "select shard_id, sum(n)::bigint as tried, sum(s)::bigint as succeeded, (sum(n) - sum(s))::bigint as failed, arg_min(error_type, (-n, error_type)) filter (where error_type is not null) as top_error, max(n) filter (where error_type is not null) as top_error_count from (select shard_id, error_type, count(*) as n, sum(success::int) as s from cr group by all) group by shard_id", reports.dashboard)


@query("select page_id, regexp_extract(url, '^(?:[^:/?#]+:)?//([^/?#]*)', 1) as key, strlen(html) as raw_size from pages where page_id % 5 <> 0")
def raw_page_messages(spark, d):
    from .sources.readers import raw_page_messages as messages

    # The id goes with its page among the headers: several pages may have one URL.
    p = A.raw_pages(spark, d).withColumns({"success": F.col("page_id") % 5 != 0, "status_code": F.lit(200), "timestamp": F.lit(0.0), "headers": F.struct("page_id")})
    return messages(p).select("headers.page_id", "key", F.col("metadata.raw_size").alias("raw_size"))
