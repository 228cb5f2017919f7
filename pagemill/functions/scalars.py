"""Scalar expressions over URLs, keys, errors, priorities and times; all native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def netloc(url: Column | str) -> Column:
    """Host with port and user part; empty if there is none."""
    return F.regexp_extract(_col(url), r"^(?:[^:/?#]+:)?//([^/?#]*)", 1)


def path_of(url: Column | str) -> Column:
    found = F.regexp_extract(_col(url), r"^(?:[^:/?#]+:)?//[^/?#]*([^?#]*)", 1)
    return F.when(found == "", "/").otherwise(found)


def object_key(url: Column | str, extension: str = "md") -> Column:
    h = F.substring(F.sha2(_col(url).cast("binary"), 256), 1, 16)
    return F.concat(netloc(url), F.lit("/"), F.substring(h, 1, 2), F.lit("/"), F.substring(h, 3, 2), F.lit("/"), h, F.lit(f".{extension}"))


def url_hash(url: Column | str) -> Column:
    return F.md5(_col(url).cast("binary"))


def shard_of_domain(domain: Column | str, shards: int) -> Column:
    """md5 of the domain modulo ``shards``, folded byte by byte so that 128 bits never overflow."""
    h = F.md5(_col(domain).cast("binary"))
    rest = F.lit(0).cast("long")
    for i in range(1, 33, 4):
        rest = (rest * 65536 + F.conv(F.substring(h, i, 4), 16, 10).cast("long")) % shards
    return rest.cast("int")


def shard_of_url(url: Column | str, shards: int) -> Column:
    """A stable stand-in for a random shard: load spreads as evenly and runs repeat."""
    return F.pmod(F.xxhash64(_col(url)), F.lit(shards)).cast("int")


def session_id(text: Column | str) -> Column:
    return F.substring(F.md5(_col(text).cast("binary")), 1, 8)


def strip_nul(c: Column | str) -> Column:
    return F.translate(_col(c), "\0", "")


def ascii_only(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"[^\x00-\x7F]", "")


def collapse(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def word_count(c: Column | str) -> Column:
    text = collapse(c)
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def keywords(c: Column | str, most: int = 20) -> Column:
    return F.slice(F.transform(F.split(_col(c), ","), lambda k: F.trim(k)), 1, most)


def epoch_to_time(c: Column | str) -> Column:
    """Seconds to a timestamp; zero counts as missing."""
    return F.when(_col(c) != 0, F.timestamp_seconds(_col(c)))


def ratio(a: Column, b: Column, scale: float = 1.0) -> Column:
    """a / b * scale, 0 where b is 0 or missing."""
    return F.coalesce(F.try_divide(a.cast("double") * scale, b.cast("double")), F.lit(0.0))


def percent(a: Column, b: Column) -> Column:
    """a of b in percent with two digits, null where b is 0."""
    return F.round(F.try_divide(a.cast("double") * 100.0, b.cast("double")), 2)


def _says(text: Column, *parts: str) -> Column:
    found = text.contains(parts[0])
    for p in parts[1:]:
        found = found | text.contains(p)
    return found


def crawl_error(message: Column | str, status: Column | str) -> Column:
    """Error type of a failed crawl: the status first, then words of the message in fixed order."""
    m, s = F.lower(F.coalesce(_col(message), F.lit(""))), _col(status)
    return (
        F.when(s == 403, "http_403_forbidden").when(s == 404, "http_404_not_found").when(s == 429, "http_429_rate_limit").when((s >= 500) & (s < 600), "http_5xx_server_error")
        .when(_says(m, "timeout"), "timeout").when(_says(m, "ssl", "certificate"), "ssl_error").when(_says(m, "connection", "connect", "refused", "reset"), "connection_error")
        .when(_says(m, "dns", "name resolution", "getaddrinfo", "nodename"), "dns_error").when(_says(m, "robots", "blocked", "불허"), "robots_blocked")
        .when(_says(m, "content", "decode", "encoding", "charset"), "content_error").otherwise("unknown")
    )


def fetch_error(kind: Column | str, message: Column | str) -> Column:
    """Error type of a fetcher's exception; connection errors are told apart by their message."""
    k, m = _col(kind), F.coalesce(_col(message), F.lit(""))
    connect = F.when(m.contains("SSL") | F.lower(m).contains("certificate"), "ssl_error").when(_says(m, "DNS", "getaddrinfo"), "dns_error").otherwise("connection_error")
    return F.when(k == "timeout", "timeout").when(k == "connect", connect).when(k == "too_many_redirects", "too_many_redirects").when(k == "read", "read_error").otherwise("unknown")


def recoverable(error: Column | str) -> Column:
    return _col(error).isin("timeout", "http_429_rate_limit", "http_5xx_server_error", "connection_error")


def rank_priority(rank: Column | str) -> Column:
    r = _col(rank)
    return F.when(r <= 100, 1000).when(r <= 1000, 900).when(r <= 10000, 800).when(r <= 100000, 700).otherwise(600)


def queue_of(priority: Column | str, url_type: Column | str) -> Column:
    p = _col(priority)
    return F.when(_col(url_type) == "custom", "priority_custom").when(p >= 900, "priority_high").when(p >= 800, "priority_medium").when(p >= 700, "priority_normal").otherwise("priority_low")


def domain_url(domain: Column | str) -> Column:
    return F.concat(F.lit("https://"), _col(domain), F.lit("/"))


def crawl_delay(robots: Column | str, default: float = 1.0, most: float = 30.0) -> Column:
    """Delay that a robots file asks for: crawl-delay, then raised by request-rate 1/n and visit-time, all capped."""
    t = F.lower(F.coalesce(_col(robots), F.lit("")))

    def number(pattern: str) -> Column:
        found = F.regexp_extract(t, pattern, 1)
        return F.when(found != "", F.least(found.cast("double"), F.lit(most)))

    delay = F.coalesce(number(r"crawl-delay:\s*(\d+\.?\d*)"), F.lit(default))
    return F.greatest(delay, number(r"request-rate:\s*1/(\d+)"), number(r"visit-time:\s*(\d+)"))


def restart_needed(processed: Column, errors: Column, memory_percent: Column) -> Column:
    return ((processed > 100) & (F.try_divide(errors, processed) > 0.5)) | (memory_percent > 90)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity in double precision; null if a vector is zero, missing or of another length."""
    a, b = _col(a), _col(b)

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    return F.when(F.size(a) == F.size(b), F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))))
