"""op9: what a page keeps, and the importance of branches against brute force."""

from math import log

import pytest

from tests.conftest import SF
from tidemark.llm import html_extract as H
from tidemark.llm.registry import op9_html_extract


def text_of(page):
    return H.main_text(H.blocks(page, H.Paths())[0])


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain  text\n here", "plain text here"),
        ("<p>a &amp; b&nbsp;c &#233;&lt;p&gt;</p><p>d<br>e</p>", "a & b c é<p>\nd e"),
        ("<nav>x</nav><article><header>t</header><p>one <b>two</b></p><aside>z</aside></article><footer>f</footer>", "t\none two"),
        ("<header>x</header><div class='content'>keep</div><div class='cookie-notice'>y</div><div id=comments><p>hi</p></div>", "keep"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\nb\nc\nd"),
        ("<script>if (a < b) { '<p>no</p>' }</script><style>p{}</style><!-- <p>no</p> --><p>yes", "yes"),
        ("<p>a<div>b</p>c", "a\nb\nc"),
        ("<form><p>name</p></form><p title='a > b'>x</p><p", "x"),
        ("<body class='no-sidebar'><p>x</p></body>", "x"),
    ],
)
def test_blocks(page, text):
    assert text_of(page) == text


def _site(n=12):
    """Pages whose boilerplate no name gives away."""
    return [(i, f"https://site.example/{i}?a=1", f"<html><body><div class=a><p>Top stories of the day</p></div><div class=b><h1>Title {i}</h1><p>Body of number {i} in full.</p></div><div class=c>All rights kept</div></body></html>") for i in range(n)]


def test_low_branches_of_a_site_go(spark):
    rows = [*_site(), (100, "https://other.example/", _site(1)[0][2]), (101, None, None), (None, "no url", "<p>x</p>"), (3, *_site()[3][1:])]
    pages = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "page_id long, url string, html string, _host string, low string, text string")
    got = {(r.page_id, r.url): r.text for r in H.with_length(pages.drop("text").withColumnRenamed("low", "path")).collect()}
    assert got[3, "https://site.example/3?a=1"] == "Title 3\nBody of number 3 in full."
    assert got[100, "https://other.example/"] == "Top stories of the day\nTitle 0\nBody of number 0 in full.\nAll rights kept"
    assert got[101, None] == "" and got[None, "no url"] == "x"
    out = H.with_length(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == len(rows)
    assert H.with_length(pages.limit(0)).count() == 0


def test_importance(spark):
    """The host's low paths, from all pages at once in plain Python."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    least = 2
    got = {(r["_host"], p) for r in H.boilerplate(pages, least_pages=least).collect() for p in r.low}
    hosts = {}
    for r in H._hosted(pages, "url", "html").select("_host", "_html").distinct().collect():
        hosts.setdefault(r["_host"], []).append(r["_html"])
    expected = set()
    for host, of in hosts.items():
        if len(of) < least:
            continue
        paths, texts, styles, parents = H.Paths(), {}, {}, {}
        for page in of:
            found, children = H.blocks(page, paths)
            for path, parent, text in {(b.path, b.parent, b.text) for b in found}:
                texts.setdefault((path, parent), {}).setdefault(text, 0)
                texts[path, parent][text] += 1
            for path, kinds in children.items():
                styles.setdefault(path, {}).setdefault(tuple(kinds), 0)
                styles[path][tuple(kinds)] += 1
        m = len(of)
        for (path, parent), counts in texts.items():
            content = 1 - sum(log(n) for n in counts.values()) / len(counts) / log(m)
            n = sum(styles.get(parent, {}).values())
            spread = -sum(k / n * log(k / n) for k in styles[parent].values()) / log(m) if n else 0.0
            if 0.9 * content + 0.1 * min(1.0, spread) < H.IMPORTANT:
                expected.add((host, path))
    assert got == expected


def test_query(spark):
    out = op9_html_extract(spark, SF).collect()
    assert len(out) == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert all(r.n_chars == len(r.text) and "<p" not in r.text for r in out) and sum(r.n_chars > 0 for r in out) > 0.9 * len(out)
