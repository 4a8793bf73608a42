"""Blocks, alignment and extraction against hand-made pages and brute force."""

from __future__ import annotations

import random
import re
import time
from html import unescape

import pytest
from pyspark.sql import types as T

from uptake.llm import html_extraction
from uptake.llm.html_blocks import blocks
from uptake.llm.html_extraction import common_lines, main_text, nearest_pages
from uptake.llm.queries import op6_html_extraction

SCHEMA = T.StructType(
    [T.StructField(c, T.LongType() if c == "page_id" else T.StringType())
     for c in ("page_id", "url", "html", "host", "key", "text")]
)
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x}</style>
<script>var t="</p><article>x</article>";</script></head><body class="has-sidebar"><header>Site</header>
<nav><ul><li>Menu</ul></nav><!-- ad <p>no</p> --><div class="ad">Buy<div>more</div>!</div>
<div class="cookie-notice">Cookies</div><form><p>Mail</p></form><aside>Side</aside>
<article><header><h1>Head &amp; &eacute;&#x41;</h1></header><p><b>One
  two<br>three<p title="a>b">4 &lt; 5<div class="comments"><p>nice!</div><p id=x hidden>no</p>
<p>six<textarea>t</textarea></article><footer>Foot</footer></body></html>"""


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def is_subsequence(part, whole):
    rest = iter(whole)
    return all(any(x == y for y in rest) for x in part)


def test_alignment_is_a_longest_common_subsequence(monkeypatch):
    rng = random.Random(5)
    for bits in (1 << 28, 12):
        monkeypatch.setattr(html_extraction, "TABLE_BITS", bits)
        for _ in range(300):
            a = [rng.randrange(5) for _ in range(rng.randrange(14))]
            b = [rng.randrange(5) for _ in range(rng.randrange(14))]
            found = common_lines(a, b)
            assert found == sorted(set(found)) and len(found) == lcs(a, b)
            assert is_subsequence([a[i] for i in found], b)


def test_blocks_of_a_page():
    kept = [b.text for b in blocks(PAGE) if not b.aside and b.article]
    assert kept == ["Head & éA", "One two three", "4 < 5", "six"]
    for odd in ("", "<", "a<b", "<p", '<p class="x', "<!--", "</", "<script>x", "<p a='>b", "&#0;&x;"):
        blocks(odd)
    assert [b.text for b in blocks("a < b <3")] == ["a < b <3"]
    assert blocks("<p " + "a='" * 50_000) == []
    assert len(blocks("<p>x" * 50_000)) == 50_000


def extract(spark, rows):
    df = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in main_text(df).collect()), key=str)


def test_shared_lines_go_and_articles_stay(spark):
    site = "<p>Welcome<p>{}<p>Imprint"
    copy = "<article><p>same</p></article>"
    rows = [
        (1, "http://a.x/p/1", site.format("one")), (2, "http://a.x/p/2?q", site.format("two")),
        (3, "http://b.x/1", copy), (4, "http://b.x/2", copy), (4, "http://b.x/2", copy),
        (5, None, "<p>Welcome"),
        (8, "http://c.x/1", "<p>all"), (9, "http://c.x/2", "<p>all"), (6, "http://A.x/zz", None), (None, "no url", "<p>q"),
        (7, "http://alone/1", "<p>only"),
    ]
    assert extract(spark, rows) == sorted(
        [(1, rows[0][1], "one"), (2, rows[1][1], "two"), (3, rows[2][1], "same"),
         (4, rows[3][1], "same"), (4, rows[3][1], "same"), (5, None, "Welcome"),
         (8, "http://c.x/1", "all"), (9, "http://c.x/2", "all"),
         (6, "http://A.x/zz", ""), (None, "no url", "q"), (7, rows[-1][1], "only")], key=str,
    )
    assert extract(spark, []) == []


def test_nearest_pages_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(f"{i:03}", f"h{rng.randrange(3)}", "/" + "".join(rng.choice("ab/") for _ in range(4)))
            for i in range(200)] + [("x", "alone", "/")]
    got = dict(nearest_pages(spark.createDataFrame(rows, "key string, host string, path string")).collect())
    ordered = sorted(rows, key=lambda r: (r[1], r[2], r[0]))

    def common(p, q):
        return next((i for i, (x, y) in enumerate(zip(p, q, strict=False)) if x != y), min(len(p), len(q)))

    for i, (key, host, path) in enumerate(ordered):
        sides = [ordered[j] for j in (i - 1, i + 1) if 0 <= j < len(ordered) and ordered[j][1] == host]
        want = max(sides, key=lambda r: common(r[2], path), default=(None,))[0]
        assert got[key] == want


def test_query_gives_the_articles_of_the_given_pages(spark, sf_dir):
    got = {r["page_id"]: r for r in op6_html_extraction(spark, sf_dir).collect()}
    for page in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", page["html"], re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", " ", p)).split())
                 for p in re.split(r"</?(?:p|h1)>", article)]
        text = "\n".join(p for p in parts if p)
        assert got[page["page_id"]]["text"] == text and got[page["page_id"]]["n_chars"] == len(text)


def test_shared_lines_of_marked_pages_go(spark):
    page = "<nav>Menu</nav><article><p>Share this story<p>{}<p>{}<p>All rights reserved</article>"
    teaser = "<article><p>See also</article><div><p>{}</div>"
    rows = [
        (1, "http://a.x/1", page.format("first text of one", "second text of one")),
        (2, "http://a.x/2", page.format("first text of two", "second text of two")),
        (3, "http://b.x/1", teaser.format("a long body in a division")),
        (4, "http://b.x/2", teaser.format("another body, as long as that")),
    ]
    assert extract(spark, rows) == [
        (1, rows[0][1], "first text of one\nsecond text of one"),
        (2, rows[1][1], "first text of two\nsecond text of two"),
        (3, rows[2][1], "a long body in a division"), (4, rows[3][1], "another body, as long as that"),
    ]


def test_near_copies_keep_their_article(spark):
    body = [f"sentence {i} of the article that both pages carry" for i in range(6)]
    site = "<p>Welcome" + "".join(f"<p>{b}" for b in body) + "<p>page {}<p>Imprint"
    other = "<p>Welcome<p>something else that is long enough to be an article<p>Imprint"
    rows = [(i, f"http://a.x/p/{i}", site.format(i)) for i in (1, 2, 3)]
    rows += [(8, "http://a.x/q", other)]
    rows += [(i, f"http://b.x/p/{i}", site.format(i)) for i in (4, 5)]
    got = {r[0]: r[2].split("\n") for r in extract(spark, rows)}
    for i in (1, 2, 3):
        assert got[i] == [*body, f"page {i}"]
    assert got[8] == ["something else that is long enough to be an article"]
    for i in (4, 5):
        assert got[i] == ["Welcome", *body, f"page {i}", "Imprint"]


ARTICLE = [f"sentence {i} of an article that says something of its own" for i in range(8)]


@pytest.mark.parametrize(
    "page",
    [
        '<div class="wrap no-sidebar">{}</div>', '<article class="post comments-open">{}</article>',
        '<article class="post">{}</article>', '<div class="search-results">{}</div>',
        '<div class="sidebar layout">{}</div>', '<noscript>{}</noscript>', '<object>{}</object>',
        '<section class="related">{}</section>', '<div id="has-comments" class="header-image">{}</div>',
    ],
)
def test_names_of_elements_lose_no_article(spark, page):
    body = "".join(f"<p>{line}</p>" for line in ARTICLE)
    notice = '<p class="notice-period">The notice period is a month.</p>'
    menu = '<nav>Home</nav><div class="cookie-banner">We use cookies</div>'
    html = f"<html><body>{menu}{page.format(body + notice)}<footer>End</footer></body></html>"
    df = spark.createDataFrame([(1, "http://a.org/x", html)], "page_id long, url string, html string")
    text = main_text(df).first()["text"]
    assert text == "\n".join([*ARTICLE, "The notice period is a month."])


def test_small_asides_by_name_still_go(spark):
    body = "".join(f"<p>{line}</p>" for line in ARTICLE)
    names = ["ad", "site-footer", "cookie-notice", "comments", "share-buttons", "nav_menu", "adBanner ad-slot"]
    asides = "".join(f'<div class="{n}">Aside {n}</div>' for n in names)
    html = f"<div>{asides}{body}{asides}</div>"
    df = spark.createDataFrame([(1, "http://a.org/x", html)], "page_id long, url string, html string")
    assert main_text(df).first()["text"] == "\n".join(ARTICLE)


def test_long_urls_are_compared_in_time(spark):
    long = "p" * 40_000
    rows = [(i, f"http://a.org/{long}{i:03}", f"<p>shared</p><p>own {i}</p>") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    start = time.perf_counter()
    assert {r["id"]: r["text"] for r in main_text(df).collect()} == {i: f"own {i}" for i in range(6)}
    assert time.perf_counter() - start < 60
