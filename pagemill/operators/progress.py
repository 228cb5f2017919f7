"""A crawl's sessions: progress, its bounded history, expiry, clean-up; and the expansion of links to a depth."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions import scalars as S
from .merge import last_n

#: Rows of history kept, hours until progress expires, days until a session goes.
HISTORY, EXPIRES_HOURS, SESSION_DAYS = 100, 48, 2
#: Rows and seconds at which a write buffer is emptied.
FLUSH_ROWS, FLUSH_SECONDS = 100, 5.0


def progress_rows(stats: DataFrame, session: str = "session_id", time: str = "timestamp", start: str = "start_time") -> DataFrame:
    """Progress records: the session's stamps, its whole minutes so far, and all counters as JSON."""
    rest = [c for c in stats.columns if c not in (session, time, start)]
    minutes = F.floor((F.col(time).cast("double") - F.col(start).cast("double")) / 60).cast("long")
    return stats.select(session, time, start, minutes.alias("uptime_minutes"), F.to_json(F.struct(*rest)).alias("data"))


def alive(rows: DataFrame, now: Column, hours: float = EXPIRES_HOURS, time: str = "timestamp") -> DataFrame:
    """Rows that have not expired."""
    return rows.where(F.col(time).cast("double") + hours * 3600 > now.cast("double"))


def latest_progress(history: DataFrame, session: str = "session_id", time: str = "timestamp") -> DataFrame:
    """The last record of each session; pre-aggregated."""
    rest = F.struct(*[c for c in history.columns if c != session])
    return history.groupBy(session).agg(F.max_by(rest, F.col(time)).alias("r")).select(session, "r.*")


def trimmed_history(history: DataFrame, session: str = "session_id", time: str = "timestamp", n: int = HISTORY) -> DataFrame:
    return last_n(history, session, time, n)


def without_old_sessions(rows: DataFrame, now: Column, days: float = SESSION_DAYS, session: str = "session_id", start: str = "start_time") -> DataFrame:
    """Rows of sessions that began within so many days; a session's start is its earliest one."""
    old = rows.groupBy(session).agg(F.min(start).alias("_start")).where(F.col("_start").cast("double") < now.cast("double") - days * 86400)
    return rows.join(old.select(session), session, "left_anti")


def flushes(rows: DataFrame, key: str, time: str, size: int = FLUSH_ROWS, seconds: float = FLUSH_SECONDS) -> DataFrame:
    """Rows (key, time, ...) with ``flush``: the number of the buffer write that takes them, per writer ``key``.

    A buffer is emptied when it holds ``size`` rows, or with the first row that comes ``seconds`` after its oldest.
    """

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, out, n, held, first = pdf.sort_values(time, kind="stable"), [], 0, 0, None
        for t in pdf[time]:
            if held and (held >= size or t - first >= seconds):
                n, held = n + 1, 0
            first = t if not held else first
            held += 1
            out.append(n)
        return pdf.assign(flush=out)

    return rows.groupBy(key).applyInPandas(number, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", flush long")


def in_batches(rows: DataFrame, size: int = 1000) -> Iterator[list[Row]]:
    """Lists of at most ``size`` rows, a partition at a time, so the driver never holds a table."""
    held: list[Row] = []
    for row in rows.toLocalIterator():
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def expand(seeds: DataFrame, links: DataFrame, most_depth: int, put=None) -> DataFrame:
    """(url, depth) of all URLs that links (source_url, url) reach from seeds (url) within ``most_depth`` steps, at their least depth.

    A level at a time: the last level's links, less what is known. ``put`` writes a level and reads it back, which
    cuts the lineage; without it levels are computed again.
    """
    found = seeds.select("url", F.lit(0).alias("depth")).distinct()
    level = found
    for depth in range(1, most_depth + 1):
        new = links.join(level.select(F.col("url").alias("source_url")), "source_url").select("url").distinct()
        level = new.join(found.select("url"), "url", "left_anti").select("url", F.lit(depth).alias("depth"))
        if put is not None:
            level = put(level, depth)
        found = found.unionByName(level)
    return found


def metric_events(values: DataFrame, kind: str, time: Column) -> DataFrame:
    """Messages of the metrics topic: the kind, the values as JSON, the time."""
    return values.select(F.lit(kind).alias("metric_type"), F.to_json(F.struct(*values.columns)).alias("data"), time.alias("timestamp"))


def send_outcome(messages: DataFrame, fits: Column) -> DataFrame:
    """(success, failed) of a batch of messages, by whether the sink takes each."""
    return messages.agg(F.count_if(fits).alias("success"), F.count_if(~F.coalesce(fits, F.lit(False))).alias("failed"))


def seed_of(scope: Column | str = "scope") -> Column:
    """The key of a scope's page counter: its seed, or what stands for it."""
    s = F.col(scope) if isinstance(scope, str) else scope
    return F.coalesce(F.nullif(s["seed_url"], F.lit("")), S.domain_url(s["allowed_domain"]))
