"""Articles of pages against a walk of the parsed JSON, and the anchors."""

import html
import json
import re

from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.plans.page_queries import _with_script, page_articles
from tidemark.sources import page_data as P


def _walk(x, depth=0):
    if isinstance(x, dict):
        yield depth, x
    for y in x.values() if isinstance(x, dict) else x if isinstance(x, list) else ():
        yield from _walk(y, depth + 1)


def _clean(x):
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split())


def _listed(page):
    m = re.search(r'<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', page, re.S)
    out = {}
    try:
        found = sorted(_walk(json.loads(m[1])), key=lambda x: x[0]) if m else []
    except ValueError:
        found = []
    for _, o in found:
        one = lambda keys: next((o[k] for k in keys if isinstance(o.get(k), str) and o[k].strip()), None)  # noqa: B023, E731
        title, link = one(P.TITLES), one(P.LINKS)
        if title and link and re.match("https?://", link) and "video" not in str(o.get("type", "")).lower() and _clean(title):
            out.setdefault(link, (_clean(title), _clean(one(P.DESCRIPTIONS) or ""), "data"))
    if not out:
        for a, body in re.findall(r"""(<a\b[^>]*href=["'][^"']+["'][^>]*>)(.*?)</a>""", page, re.S):
            link, title = html.unescape(re.search(r"""href=["']([^"']+)["']""", a)[1]), _clean(body)
            if len(title) >= P.LEAST_ANCHOR:
                out.setdefault(link, (title, "", "anchor"))
    return out


def test_page_articles(spark):
    pages = {r.page_id: r.html for r in _with_script(spark, SF).collect()}
    got = {}
    for r in page_articles(spark, SF).collect():
        got.setdefault(r.page_id, {})[r.link] = (r.title, r.description, r.kind)
    assert got == {k: x for k, x in ((k, _listed(h)) for k, h in pages.items()) if x}
    assert {x[2] for of in got.values() for x in of.values()} == {"data", "anchor"}


def test_data_at_any_depth(spark):
    deep = {"title": "end", "url": "https://x.example/9"}
    for _ in range(8):
        deep = {"a": [deep, 1, "text", None]}
    pages = [
        (1, f'<script id="__NEXT_DATA__">{json.dumps(deep)}</script>'),
        (2, '<script id="__NEXT_DATA__">{broken</script><a href="https://x.example/1">a title</a>'),
        (3, '<script id="__NEXT_DATA__">[{"headline": " ", "title": 5, "name": "Name", "url": "", "link": "https://x.example/2", "dek": "d &amp; e"}]</script>'),
        (4, ""), (5, None), (6, '<script id="__NEXT_DATA__">"only text"</script>'),
    ]
    got = {(r.k, r.link): (r.title, r.description, r.kind) for r in P.articles(spark.createDataFrame(pages, "k int, html string"), "k", "html").collect()}
    assert got == {(1, "https://x.example/9"): ("end", "", "data"), (2, "https://x.example/1"): ("a title", "", "anchor"), (3, "https://x.example/2"): ("Name", "d & e", "data")}
    assert P.objects(spark.createDataFrame([(1, None)], "k int, s string").select("k", F.try_parse_json("s").alias("v")), "k", "v").count() == 0


def test_references_in_data(spark):
    """Quotes that a script has as references don't end its strings; data that are written in references are read all the same."""
    one = {"title": "a &quot;b&quot; &amp; c", "url": "https://x.example/1?a&amp;b"}
    pages = [(1, f'<script id="__NEXT_DATA__">{json.dumps(one)}</script>'), (2, f'<script id="__NEXT_DATA__">{html.escape(json.dumps({"name": "d", "link": "https://x.example/2"}))}</script>')]
    got = {(r.k, r.link, r.title, r.kind) for r in P.articles(spark.createDataFrame(pages, "k int, html string"), "k", "html").collect()}
    assert got == {(1, "https://x.example/1?a&b", 'a "b" & c', "data"), (2, "https://x.example/2", "d", "data")}


def test_identity(spark):
    from tidemark.functions import articles as A

    uuid = "01234567-89ab-4cde-8f01-23456789abcd"
    rows = [
        ("https://cn.wsj.com/articles/Title-0a1b2c3d4e", "", ("wsj", "https://cn.wsj.com/articles/Title-0a1b2c3d4e", "0a1b2c3d4e")),
        (f"  https://CN.WSJ.COM.:443//articles//x-{uuid.upper()}/?a=1#b ", "", ("wsj", f"https://cn.wsj.com/articles/x-{uuid.upper()}", uuid)),
        ("https://cn.wsj.com/articles/abc", "", ("wsj", "https://cn.wsj.com/articles/abc", "")),
        ("https://cn.wsj.com/articles/", "", None), ("https://cn.wsj.com/news/x", "", None), ("http://cn.wsj.com/articles/x", "", None), ("https://cn.wsj.com:8443/articles/x", "", None), ("https://evil.example/articles/x", "", None),
        ("https://cn.wsj.com/articles/video/x", "", None), ("https://cn.wsj.com/articles/x?Type=Video", "", None), ("https://cn.wsj.com.evil.example/articles/x", "", None),
        ("https://www.economist.com/leaders/2024/02/29/a-name", f" {uuid.upper()} ", ("economist", "https://www.economist.com/leaders/2024/02/29/a-name", uuid)),
        ("https://www.economist.com/leaders/2024/02/29/a-name/?x", "no id", ("economist", "https://www.economist.com/leaders/2024/02/29/a-name", "")),
        ("https://www.economist.com/leaders/2023/02/29/a-name", "", None), ("https://www.economist.com/leaders/1899/02/01/a-name", "", None), ("https://www.economist.com/Podcasts/2024/02/01/a", "", None),
        ("https://user:pw@www.economist.com/leaders/2024/02/01/a", "", None), ("https://www.economist.com/leaders/2024/02/01", "", None), (None, None, None), ("", "", None), ("not a url", "", None),
    ]
    df = spark.createDataFrame([(i, u, f) for i, (u, f, _) in enumerate(rows)], "i int, u string, f string")
    for r in df.select("i", A.identity(F.col("u"), F.col("f")).alias("x")).collect():
        assert (r.x and tuple(r.x)[:3]) == rows[r.i][2], rows[r.i]
