import re

import pytest

from pagemill import api
from pagemill.functions import scoring

TEXT = "The harbour town kept its market on the long quay, and every morning the boats came in with the tide. " * 4
ARTICLE = f"<html lang='ko'><head><title>Quay</title></head><body><article><h1>Boats</h1><p>{TEXT}</p><p>{TEXT}</p></article></body></html>"
SPA = '<html><body><div id="root"></div><noscript>You need to enable JavaScript</noscript><script src="/static/bundle.a1b2c3.js"></script></body></html>'
PAGES = {
    "article": ARTICLE, "spa": SPA, "short": "<html><body><p>Hi</p></body></html>", "cms": f'<html><head><meta name="generator" content="WordPress 6"></head><body class="wp-content"><p>{TEXT}</p></body></html>',
    "angular": '<html ng-app="shop"><body ng-controller="Main"><p>x</p></body></html>',
    "worst": '<html><body ng-app class="loading"><div id="app"></div><script>fetch("/x"); window.__NUXT__ = 1; history.push(1)</script>' + "<script></script>" * 25 + "<div v-if=a data-src=b></div></body></html>",
    "table": "<table><tr><td>a</td></tr></table>" + "<ul>" + "<li>x</li>" * 4 + "</ul>", "open list": "<ul>" + "<li>x" * 200, "empty": "", "scripts": "<script></script>" * 11 + TEXT * 6,
}


def plain_score(html):
    text = re.sub(r"<style[^>]*>.*?</style>", "", re.sub(r"<script[^>]*>.*?</script>", "", html, flags=re.I | re.S), flags=re.I | re.S)
    n = len(re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", text)).strip())
    k = len(re.findall(r"<script[^>]*>", html, re.I))
    s = 100 + (-35 if n < 300 else -20 if n < 500 else 15 if n > 5000 else 10 if n > 2000 else 0) + (-15 if k > 20 else -5 if k > 10 else 0)
    s += sum(d for _, d, p in scoring.DYNAMIC if re.search(p, html, re.I))
    return s + sum(d for name, d, p, dot in scoring.STATIC if (name != "list_content" or "</ul>" in html) and re.search(p, html, re.I | (re.S if dot else 0)))


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame(list(PAGES.items()), "url string, html string")
    return {r.url: r for r in api.analyse(df).collect()}


def test_scores_equal_plain_python(scored):
    assert {k: r.raw_score for k, r in scored.items()} == {k: plain_score(v) for k, v in PAGES.items()}


def test_expected_bands(scored):
    assert scored["article"].score >= 70 and scored["article"].route == "fast"
    assert scored["spa"].score < 80 and scored["spa"].route == "rich"
    assert scored["short"].score < 70 and "Very short content" in scored["short"].score_reasons[0]
    assert scored["angular"].score < 60 and any(r.startswith("angular") for r in scored["angular"].score_reasons)
    assert "wordpress (+15)" in scored["cms"].score_reasons and scored["cms"].cms == "WordPress"
    assert all(0 <= r.score <= 100 for r in scored.values())
    assert all(len(r.score_reasons) <= 5 for r in scored.values())


def test_route_reason(scored):
    r = scored["spa"]
    assert r.route_reason == f"Score {r.score} < 80: Dynamic page, requires Crawl4AI"


def test_counts_and_stack(spark):
    html = '<h1>a</h1><h2>b</h2><p>x</p><p>y</p><a href="/1">l</a><a class=c href="/2">m</a><img src=i><script src="/jquery.js"></script><link rel="stylesheet" href="bootstrap.css">'
    r = api.analyse_text(spark, html).first()
    assert (r.heading_count, r.paragraph_count, r.link_count, r.image_count, r.script_count, r.style_count) == (2, 2, 2, 1, 1, 1)
    assert r.frameworks == ["jQuery", "Bootstrap"]


def test_hostile_pages_end(spark):
    pages = ["<p>" + "<p>x</p>" * 20_000, "<ul>" + "<li>x</li>" * 20_000, "<table>" + "<tr><td>" * 10_000, "<ul>" * 2_000]
    df = spark.createDataFrame([(str(i), p) for i, p in enumerate(pages)], "url string, html string")
    assert scoring.analyse(df).select("raw_score").count() == 4


def test_threshold(spark):
    df = spark.createDataFrame([("u", SPA)], "url string, html string")
    assert scoring.analyse(df, threshold=0).first().route == "fast"
