"""URL normalisation, seeds and absolute links: Arrow-batched, with a native path for URLs without a query."""

from __future__ import annotations

from urllib.parse import parse_qs, urlencode, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrow import arrow_udf

#: Query parameters that only track visitors.
TRACKING = frozenset((
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "utm_source_platform", "utm_creative_format", "utm_marketing_tactic",
    "fbclid", "gclid", "msclkid", "twclid", "igshid", "yclid", "dclid", "ttclid", "li_fat_id", "mc_cid", "mc_eid", "vero_id", "_hsenc", "_hsmi",
    "ref", "referrer", "source", "_ga", "_gl", "pk_campaign", "pk_kwd", "pk_source", "pk_medium",
))


def clean_url(url: str | None) -> str | None:
    """The canonical form of an http(s) URL, or None.

    The host is lower-cased, tracking and blank parameters and the fragment go, an empty path becomes ``/``,
    and what is left of the query is encoded anew, values of one name together.
    """
    try:
        parts = urlsplit((url or "").strip())
        if parts.scheme not in ("http", "https") or not parts.netloc:
            return None
        kept = {k: v for k, v in parse_qs(parts.query).items() if k.lower() not in TRACKING}
    except ValueError:
        return None
    query = urlencode(kept, doseq=True)
    return f"{parts.scheme}://{parts.netloc.lower()}{parts.path or '/'}" + (f"?{query}" if query else "")


def clean_urls(urls) -> list[str]:
    """Canonical forms of a list in order of first appearance."""
    return list(dict.fromkeys(u for u in map(clean_url, urls) if u))


@arrow_udf("string")
def _clean(urls: pd.Series) -> pd.Series:
    return urls.map(clean_url)


@arrow_udf("array<string>", once=True)
def clean_all(urls: pd.Series) -> pd.Series:
    """``clean_urls`` of each list; a null list gives an empty one."""
    return urls.map(lambda x: [] if x is None else clean_urls(x))


def normalise(url: Column | str) -> Column:
    """``clean_url`` as a column. URLs with a query go through Python, plain ones stay native."""
    u = F.trim(F.col(url) if isinstance(url, str) else url)
    bare = F.regexp_replace(u, r"#.*$", "")
    plain = u.rlike(r"^https?://[A-Za-z0-9._:\-]+(/[A-Za-z0-9._~/\-]*)?(#.*)?$")
    host = F.regexp_extract(bare, r"^(https?)://([^/]+)(.*)$", 2)
    path = F.regexp_extract(bare, r"^(https?)://([^/]+)(.*)$", 3)
    native = F.concat(F.regexp_extract(bare, r"^(https?)", 1), F.lit("://"), F.lower(host), F.when(path == "", "/").otherwise(path))
    return F.when(plain, native).otherwise(_clean(F.when(~plain, u)))


def seed_url(seed: str | None) -> str | None:
    """A seed as a URL: https:// if it has no scheme, no query, no fragment."""
    seed = (seed or "").strip()
    if not seed:
        return None
    found = clean_url(seed if "://" in seed else f"https://{seed}")
    return found.split("?")[0] if found else None


@arrow_udf("string")
def normalise_seed(seeds: pd.Series) -> pd.Series:
    return seeds.map(seed_url)


@arrow_udf("string")
def absolute(base: pd.Series, link: pd.Series) -> pd.Series:
    """The link seen from its page; null if it can't be joined."""

    def join(b, x):
        try:
            return urljoin(b or "", x) if x is not None else None
        except ValueError:
            return None

    return pd.Series([join(b, x) for b, x in zip(base, link, strict=True)])
