"""Static score of a page, as one expression per rule: no UDF, everything inside code generation.

A page starts at 100; bands of its text length and script count and rules found in its HTML move the
score; it is clamped to 0..100 and compared with a threshold. Each rule counts once.

Patterns keep Python's meaning of ``.``, ``\\s`` and ``\\w`` under Java through the flags (?idU). The three
rules that look for repeated elements are written with atomic groups: each gap stops at its earliest
end, which is complete when only existence matters, and neither recursion nor backtracking can blow up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrow import spread

THRESHOLD = 80

#: Fixed values: (name, delta, pattern) of the signs of a page that needs a browser.
DYNAMIC = (
    ("next_js", -25, r"__NEXT_DATA__|_next/static"),
    ("nuxt_js", -20, r"window\.__NUXT__|_nuxt/"),
    ("angular", -40, r"ng-app|ng-controller|angular\.module"),
    ("react_csr", -35, r"""<div\s+id=["']root["']\s*>\s*</div>|<div\s+id=["']app["']\s*>\s*</div>"""),
    ("react_ssr", -10, r"data-reactroot|data-react-helmet"),
    ("vue_js", -30, r"v-cloak|v-if|v-for|Vue\.component"),
    ("svelte", -20, r"svelte-\w+|__svelte"),
    ("webpack_bundle", -20, r"""<script[^>]*src=["'][^"']*(?:bundle|chunk|vendor)\.[a-f0-9]+\.js"""),
    ("heavy_js", -5, r"""<script[^>]*src=["'][^"']*\.js["'][^>]*>\s*</script>"""),
    ("lazy_loading", -15, r"""loading=["']lazy["']|data-src=|lazyload"""),
    ("infinite_scroll", -10, r"infinite.?scroll|load.?more|pagination"),
    ("ajax_content", -25, r"\.ajax\(|fetch\(|XMLHttpRequest|axios\."),
    ("noscript_warning", -20, r"<noscript[^>]*>.*(?:enable|javascript|browser)"),
    ("loading_ui", -25, r"""class=["'][^"']*(?:loading|spinner|skeleton|placeholder)[^"']*["']"""),
    ("empty_body", -40, r"<body[^>]*>\s*(?:<div[^>]*>\s*</div>\s*)*</body>"),
    ("spa_router", -15, r"react-router|vue-router|@angular/router|history\.push"),
    ("web_components", -15, r"customElements\.define|<template\s+id="),
)
#: Fixed values: (name, delta, pattern, whether a dot spans lines) of the signs of a static page.
STATIC = (
    ("article_tag", 20, r"<article[^>]*>", False),
    ("main_content", 15, r"""<main[^>]*>|id=["'](?:content|main)["']""", False),
    ("header_structure", 10, r"<h1[^>]*>.*?</h1>", False),
    ("long_paragraphs", 15, r"<p[^>]*>.{200,}</p>", False),
    ("multiple_paragraphs", 10, r"(?:<p[^>]*>.*?</p>.*?){3,}", True),
    ("static_generator", 25, r"generator.*(?:Jekyll|Hugo|Gatsby|11ty|Astro|Hexo)", False),
    ("ssr_content", 10, r"""<meta[^>]*(?:description|og:description)[^>]*content=["'][^"']{50,}""", False),
    ("table_data", 10, r"<table[^>]*>.*?<tr>.*?</tr>.*?</table>", True),
    ("list_content", 10, r"<(?:ul|ol)[^>]*>(?:.*?<li[^>]*>.*?</li>.*?){3,}</(?:ul|ol)>", True),
    ("wordpress", 15, r"wp-content|wordpress|wp-includes", False),
    ("cms_meta", 15, r"generator.*(?:WordPress|Drupal|Joomla|Wix|Squarespace)", False),
)
#: The linear forms of the rules that would recurse or backtrack without bound.
LINEAR = {
    "multiple_paragraphs": r"<p[^>]*>(?>.*?</p>)(?>.*?<p[^>]*>)(?>.*?</p>)(?>.*?<p[^>]*>)(?>.*?</p>)",
    "table_data": r"<table[^>]*>(?>.*?<tr>)(?>.*?</tr>)(?>.*?</table>)",
    "list_content": r"<(?:ul|ol)[^>]*>(?>.*?<li[^>]*>)(?>.*?</li>)(?>.*?<li[^>]*>)(?>.*?</li>)(?>.*?<li[^>]*>)(?>.*?</li>)(?>.*?</(?:ul|ol)>)",
}
#: Patterns looked for in lower-cased HTML, by the name reported.
FRAMEWORKS = (
    ("React", "react|_react|__REACT"), ("Vue.js", "vue|v-cloak|v-if"), ("Angular", "angular|ng-app|ng-controller"), ("Next.js", "__NEXT_DATA__|_next/"),
    ("Nuxt.js", "__NUXT__|_nuxt/"), ("Svelte", "svelte|__svelte"), ("jQuery", r"jquery|\$\("), ("Bootstrap", "bootstrap"), ("Tailwind", "tailwindcss|tailwind"),
)
CMS = (
    ("WordPress", "wp-content|wordpress"), ("Drupal", "drupal|/sites/default/"), ("Joomla", "joomla|/components/com_"), ("Shopify", r"shopify|cdn\.shopify"),
    ("Wix", r"wix\.com|wixstatic"), ("Squarespace", "squarespace|sqsp"), ("Ghost", "ghost|/ghost/"),
)
ANALYTICS = (
    ("Google Analytics", r"google-analytics|googletagmanager|gtag\(|ga\("), ("Facebook Pixel", r"facebook.*pixel|fbq\("), ("Hotjar", "hotjar"), ("Mixpanel", "mixpanel"), ("Amplitude", "amplitude"),
)
#: What is counted in a page, and how.
COUNTS = {
    "paragraph_count": "<p[^>]*>", "heading_count": "<h[1-6][^>]*>", "link_count": "<a[^>]*href=", "image_count": "<img[^>]*>",
    "script_count": "<script[^>]*>", "style_count": "<style[^>]*>|<link[^>]*stylesheet",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def plain_text(html: Column | str) -> Column:
    """The text without scripts, styles and tags, white space collapsed."""
    text = F.regexp_replace(_col(html), r"(?isU)<script[^>]*>.*?</script>", "")
    text = F.regexp_replace(text, r"(?isU)<style[^>]*>.*?</style>", "")
    text = F.regexp_replace(F.regexp_replace(text, r"<[^>]+>", " "), r"(?U)\s+", " ")
    return F.trim(text)


def text_length(html: Column | str) -> Column:
    return F.length(plain_text(html))


def script_count(html: Column | str) -> Column:
    return F.regexp_count(_col(html), F.lit("(?i)<script[^>]*>"))


def length_band(n: Column) -> Column:
    return F.when(n < 300, -35).when(n < 500, -20).when(n > 5000, 15).when(n > 2000, 10).otherwise(0)


def script_band(n: Column) -> Column:
    return F.when(n > 20, -15).when(n > 10, -5).otherwise(0)


def rules() -> list[tuple[str, int, str]]:
    """(name, delta, Java pattern) in the order in which reasons are listed."""
    return [(n, d, "(?idU)" + p) for n, d, p in DYNAMIC] + [(n, d, ("(?idUs)" if dot else "(?idU)") + LINEAR.get(n, p)) for n, d, p, dot in STATIC]


def signals(html: Column | str) -> Column:
    """What the score needs, measured once: (text_length, script_count, hits: one flag a rule)."""
    return F.struct(text_length(html).alias("text_length"), script_count(html).alias("script_count"), F.array(*[F.coalesce(_col(html).rlike(p), F.lit(False)) for *_, p in rules()]).alias("hits"))


def raw_score(s: Column) -> Column:
    """The score before clamping, from ``signals``."""
    total = F.lit(100) + length_band(s["text_length"]) + script_band(s["script_count"])
    for i, (_, delta, _) in enumerate(rules()):
        total = total + F.when(s["hits"][i], delta).otherwise(0)
    return total


def clamp(score: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(100), score))


def route(score: Column, threshold: int = THRESHOLD) -> Column:
    return F.when(score >= threshold, "fast").otherwise("rich")


#: Fixed values from here to ``reasons``: the texts of reasons.
def route_reason(score: Column, threshold: int = THRESHOLD) -> Column:
    return F.when(score >= threshold, F.format_string(f"Score %d >= {threshold}: Static page, suitable for BeautifulSoup", score)).otherwise(F.format_string(f"Score %d < {threshold}: Dynamic page, requires Crawl4AI", score))


def reasons(s: Column) -> Column:
    """Reasons in order: text length, scripts, dynamic rules, static rules."""
    n, k = s["text_length"], s["script_count"]
    length = F.when(n < 300, F.format_string("Very short content (%d chars) (-35)", n)).when(n < 500, F.format_string("Short content (%d chars) (-20)", n)).when(n > 5000, F.format_string("Rich content (%d chars) (+15)", n)).when(n > 2000, F.format_string("Good content (%d chars) (+10)", n))
    scripts = F.when(k > 20, F.format_string("Many scripts (%d) (-15)", k)).when(k > 10, F.format_string("Several scripts (%d) (-5)", k))
    found = [F.when(s["hits"][i], F.lit(f"{name} ({delta:+d})")) for i, (name, delta, _) in enumerate(rules())]
    return F.array_compact(F.array(length, scripts, *found))


def _named(html: Column, table) -> list[Column]:
    return [F.when(F.lower(html).rlike(p), F.lit(name)) for name, p in table]


def frameworks(html: Column | str) -> Column:
    """Frameworks in lower-cased HTML; patterns in capitals never match, as is expected."""
    return F.array_compact(F.array(*_named(_col(html), FRAMEWORKS)))


def cms(html: Column | str) -> Column:
    return F.coalesce(*_named(_col(html), CMS))


def analytics(html: Column | str) -> Column:
    return F.array_compact(F.array(*_named(_col(html), ANALYTICS)))


def element_counts(html: Column | str) -> list[Column]:
    return [F.regexp_count(_col(html), F.lit(f"(?i){p}")).alias(name) for name, p in COUNTS.items()]


def score_bucket(score: Column) -> Column:
    return F.when(score <= 20, "0-20").when(score <= 40, "21-40").when(score <= 60, "41-60").when(score <= 80, "61-80").otherwise("81-100")


def analyse(pages, html: str = "html", threshold: int = THRESHOLD):
    """``pages`` with raw_score, score, route, route_reason, score_reasons (first five), text_length, script_count."""
    s = F.col("_signals")
    pages = spread(pages)
    out = pages.withColumn("_signals", signals(html)).withColumn("raw_score", raw_score(s)).withColumn("score", clamp(F.col("raw_score")))
    score = F.col("score")
    return out.withColumns({"route": route(score, threshold), "route_reason": route_reason(score, threshold), "score_reasons": F.slice(reasons(s), 1, 5), "text_length": s["text_length"], "script_count": s["script_count"]}).drop("_signals")
