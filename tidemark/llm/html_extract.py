"""Main text of pages by site style trees.

The DOMs of a host are merged into its style tree: nodes are element paths with their classes. A text node's content
importance is 1 less the mean entropy of its distinct contents over the host's pages (a content that all pages hold has
entropy 1, one that a single page holds 0), log base the number of pages. An inner node's presentation importance is the
entropy of the styles that its children come in. A branch's importance is the content's with a tenth of its parent's
presentation; a branch of less than IMPORTANT on a host of PAGES or more distinct pages is boilerplate there.

From a page go branches of low importance, and those whose element, class, id or role says what they are (navigation,
footers, adverts, forms, notices, comments ...), which also covers hosts of few pages; where a page has an article or
main element, so does all outside of it. If low importance alone would leave nothing, it is not applied to that page:
on a host whose pages are near copies the articles themselves look like boilerplate. Copies of a page count once.

Cases: null html is empty and gives empty text; a null or broken url is a host of its own. A null page_id stays null;
repeated rows are extracted each; an empty table gives no row; other columns are ignored. Unclosed elements end with
their parent, an unclosed tag at the end of a page is dropped.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import cut, prepare

PAGES, IMPORTANT, PRESENTATION = 8, 0.15, 0.1
#: Hosts with boilerplate up to which their lists are broadcast (some 100 bytes each); beyond, they are joined by a shuffle.
BROADCAST_HOSTS = 100_000

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[a-zA-Z/][^>]*\Z""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|\Z)""", re.I)
_TOKEN = re.compile(r"[a-z0-9]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = {x: re.compile(rf"</{x}\b[^>]*>", re.I) for x in ("script", "style", "noscript", "iframe", "textarea", "title", "template", "svg", "noembed", "noframes")}
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_MAIN = frozenset(("article", "main"))
_NOISE_TAGS = frozenset("head nav footer aside form button select dialog menu object canvas video audio".split())
_NOISE_WORDS = frozenset("ad ads adv advert adverts advertisement sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar aside footer cookie cookies consent gdpr notice banner popup modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations comment comments disqus respond reply login search pagination pager widget widgets toolbar contentinfo complementary".split())
_HEAD_WORDS = frozenset(("header", "masthead", "banner"))
#: An element that ends an open one of these when it starts, up to the nearest of the second kind.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}


class Block:
    __slots__ = ("inside", "noise", "parent", "path", "text")

    def __init__(self, path: int, parent: int, noise: bool, inside: bool, text: str):
        self.path, self.parent, self.noise, self.inside, self.text = path, parent, noise, inside, text


class Paths:
    """Numbers of element paths, the same in every task: a hash of the parent's number and the element's style."""

    def __init__(self):
        from xxhash import xxh64_intdigest

        self.digest, self.known = xxh64_intdigest, {}

    def child(self, parent: int, style: str) -> int:
        key = parent, style
        if key not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[key] = self.digest(f"{parent}/{style}") - 2**63
        return self.known[key]


def blocks(page: str, paths: Paths) -> tuple[list[Block], dict[int, list[int]]]:
    """The blocks of text in page order, and the styles of each inner node's children."""
    out: list[Block] = []
    children: dict[int, list[int]] = {}
    # an open element: tag, path, noise, inside an article
    stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
    held: list[str] = []

    def flush() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                at = len(stack) - 1
                while at and stack[at][0] in _INLINE:
                    at -= 1
                _, path, _, _ = stack[at]
                out.append(Block(path, stack[at - 1][1] if at else 0, stack[-1][2] or stack[at][2], stack[at][3], text))

    def close(tags: frozenset | set, upto: frozenset | set) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in upto:
                return
            if stack[k][0] in tags:
                flush()
                del stack[k:]
                return

    at = 0
    while m := _TAG.search(page, at):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag not in _INLINE:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    flush_noise = stack[-1][2]
                    if held and flush_noise:
                        flush()
                    del stack[k:]
                    break
                if tag in _INLINE and stack[k][0] not in _INLINE:
                    break
            continue
        if tag in _RAW:
            flush()
            if not m[3].endswith("/"):
                end = _RAW[tag].search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag not in _INLINE:
            flush()
            close({"p"}, {"table", "td", "button", "object"})
            if tag in _ENDS:
                close(*_ENDS[tag])
        if tag in _VOID:
            continue
        _, above, noise, inside = stack[-1]
        words: list[str] = []
        style = tag
        if m[3]:
            for a in _ATTRIBUTE.finditer(m[3]):
                name, value = a[1].lower(), (a[2] or a[3] or a[4] or "").lower()
                if name == "hidden":
                    noise = True
                elif name == "class":
                    style += "." + ".".join(sorted(value.split()))
                words += _TOKEN.findall(value)
        inside = inside or tag in _MAIN
        if tag in _NOISE_TAGS or (tag == "header" and not inside) or any(w in _NOISE_WORDS or (w in _HEAD_WORDS and not inside) for w in words):
            if tag not in ("html", "body") and tag not in _MAIN:
                if held:
                    flush()
                noise = True
        if tag in _INLINE and not noise:
            stack.append((tag, above, noise, inside))
            continue
        path = paths.child(above, style)
        children.setdefault(above, []).append(path)
        stack.append((tag, path, noise, inside))
    held.append(page[at:])
    flush()
    return out, children


def main_text(found: list[Block], low: frozenset | set = frozenset()) -> str:
    """The blocks that stay, one a line. low: paths of low importance."""
    if any(b.inside for b in found):
        found = [b for b in found if b.inside]
    clean = [b for b in found if not b.noise]
    return "\n".join([b.text for b in clean if b.path not in low] or [b.text for b in clean])


def _nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    paths = Paths()
    digest = paths.digest
    for batch in batches:
        rows: dict[str, list] = {k: [] for k in ("host", "page", "path", "parent", "content", "feature")}

        def add(host: str, page: int, path: int, parent: int, content: bool, feature: int, rows: dict = rows) -> None:
            for k, v in zip(rows, (host, page, path, parent, content, feature), strict=True):
                rows[k].append(v)

        for host, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            page = digest(text) - 2**63
            found, children = blocks(text, paths)
            for path, parent, feature in {(b.path, b.parent, digest(b.text) - 2**63) for b in found}:
                add(host, page, path, parent, True, feature)
            for path, styles in children.items():
                add(host, page, path, 0, False, digest(repr(styles)) - 2**63)
        yield pa.RecordBatch.from_pydict(rows, schema=_NODES)


_NODES = pa.schema([("host", pa.string()), ("page", pa.int64()), ("path", pa.int64()), ("parent", pa.int64()), ("content", pa.bool_()), ("feature", pa.int64())])


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    paths = Paths()
    for batch in batches:
        texts = [main_text(blocks(page, paths)[0], set(low or ())) for page, low in zip(batch.column("_html").to_pylist(), batch.column("low").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _hosted(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    host = F.regexp_extract(F.lower(F.coalesce(pages[url_col], F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return pages.withColumns({"_host": host, "_html": F.coalesce(pages[html_col], F.lit(""))})


def boilerplate(pages: DataFrame, url_col: str = "url", html_col: str = "html", least_pages: int = PAGES, important: float = IMPORTANT) -> DataFrame:
    """_host, low: of each host that has any, the paths of its style tree that are of low importance.

    Contents and styles are counted by distinct page before anything meets by host or path, so a host with a third of
    all pages is many keys.
    """
    prepare(pages.sparkSession)
    nodes = _hosted(pages, url_col, html_col).select("_host", "_html").mapInArrow(_nodes, "host string, page long, path long, parent long, content boolean, feature long")
    seen = nodes.distinct().groupBy("host", "path", "parent", "content", "feature").agg(F.count("*").alias("pages"))
    sums = seen.groupBy("host", "path", "parent", "content").agg(F.count("*").alias("features"), F.sum(F.log("pages")).alias("logs"), F.sum("pages").alias("total"), F.sum(F.col("pages") * F.log("pages")).alias("weighted"), F.max("pages").alias("most"))
    sums = cut(sums)
    # every page has the outermost node once, so the styles of that node count the host's pages
    hosts = sums.where("path = 0 and not content").select("host", F.col("total").alias("m")).where(F.col("m") >= least_pages)
    styles = sums.where("not content").select("host", F.col("path").alias("parent"), (F.log("total") - F.col("weighted") / F.col("total")).alias("spread"))
    text = sums.where("content").join(hosts, "host").join(styles, ["host", "parent"], "left")
    content = 1 - F.col("logs") / F.col("features") / F.log("m")
    presentation = F.least(F.lit(1.0), F.coalesce("spread", F.lit(0.0)) / F.log("m"))
    low = text.where((1 - PRESENTATION) * content + PRESENTATION * presentation < important)
    return low.groupBy(F.col("host").alias("_host")).agg(F.collect_set("path").alias("low"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **more) -> DataFrame:
    """page_id, url, text."""
    low = cut(boilerplate(pages, url_col, html_col, **more))
    if low.count() <= BROADCAST_HOSTS:
        low = F.broadcast(low)
    rows = _hosted(pages, url_col, html_col).select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), "_host", "_html")
    return rows.join(low, "_host", "left").select("page_id", "url", "_html", "low").mapInArrow(_texts, "page_id long, url string, text string")


def with_length(pages: DataFrame, **more) -> DataFrame:
    """extract with the text's code points."""
    return extract(pages, **more).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
