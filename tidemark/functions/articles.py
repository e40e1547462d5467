"""Identity of articles: strict canonical addresses of two kinds of publisher, ids in them, and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.urls import HEX_END, UUID_END


@dataclass(frozen=True)
class Publisher:
    """Where a publisher's articles are: by a folder, or by a date in the path."""

    name: str
    host: str
    dated: bool = False


#: The publishers that are let in, sections of the dated one that aren't articles, and what marks a film.
PUBLISHERS = (Publisher("wsj", "cn.wsj.com"), Publisher("economist", "www.economist.com", dated=True))
_NOT_ARTICLES = ("audio", "films", "interactive", "podcast", "podcasts", "video", "videos")
_FILMS = ("video", "videos")
_UUID = UUID_END.replace("(?:^|-)", "^")


def _parts(url: Column) -> dict[str, Column]:
    """scheme, user, host, port, path and query; the path without double and last slashes."""
    whole = r"(?i)^([a-z][a-z0-9+.-]*)://(?:([^/?#@]*)@)?([^/?#:@]*)(?::([0-9]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
    at = lambda i: F.regexp_extract(F.trim(url), whole, i)
    path = F.rtrim(F.regexp_replace(at(5), "/{2,}", "/"), F.lit("/"))
    return {"scheme": F.lower(at(1)), "user": F.trim(url).rlike(r"^[^/?#]*://[^/?#]*@"), "host": F.regexp_replace(F.lower(at(3)), r"\.+$", ""), "port": at(4), "path": path, "query": at(6)}


def _film(path: Column, query: Column) -> Column:
    asked = F.exists(F.split(F.lower(query), "&"), lambda x: x.isin("type=video", "content_type=video"))
    return F.arrays_overlap(F.split(F.lower(path), "/"), F.array(*map(F.lit, _FILMS))) | asked


def canonical(url: Column, publisher: Publisher) -> Column:
    """UR-2, UR-3, FL-12: the address without query, or null if it is none of the publisher's articles. The path keeps its case.

    A dated address has a section that has articles, a date that exists, from 1900 to 2099, and a name."""
    p = _parts(url)
    ours = (p["scheme"] == "https") & (p["host"] == publisher.host) & p["port"].isin("", "443")
    if publisher.dated:
        form = "(?i)^/([a-z0-9-]+)/([0-9]{4})/([0-9]{2})/([0-9]{2})/[a-z0-9][a-z0-9-]*$"
        of = lambda i: F.regexp_extract(p["path"], form, i)
        day = F.try_to_timestamp(F.concat_ws("-", of(2), of(3), of(4)), F.lit("yyyy-MM-dd"))
        ours = ours & ~p["user"] & p["path"].rlike(form) & ~F.lower(of(1)).isin(*_NOT_ARTICLES) & day.isNotNull() & F.year(day).between(1900, 2099)
    else:
        ours = ours & F.lower(p["path"]).startswith("/articles/") & ~_film(p["path"], p["query"])
    return F.when(ours, F.concat(F.lit(f"https://{publisher.host}"), p["path"]))


def identity(url: Column, feed_id: Column | None = None) -> Column:
    """UR-2 to UR-5: a struct of publisher, canonical, article_id and article_key; null for an address that no publisher has.

    An article's id is the UUID or the hex digits that end its address, or, of a dated publisher, the UUID that its feed gives; without one
    the digest of the address is its key."""
    out = F.lit(None)
    for p in reversed(PUBLISHERS):
        address = canonical(url, p)
        if p.dated:
            given = F.lower(F.trim(F.coalesce(feed_id, F.lit("")))) if feed_id is not None else F.lit("")
            own, kind = F.when(given.rlike(_UUID), given).otherwise(""), f"{p.name}-url:"
        else:
            slug = F.lower(F.element_at(F.split(address, "/"), -1))
            long = F.regexp_extract(slug, UUID_END, 1)
            own, kind = F.when(long != "", long).otherwise(F.regexp_extract(slug, HEX_END, 1)), "url:"
        key = F.when(own != "", F.concat(F.lit(f"{p.name}:"), own)).otherwise(F.concat(F.lit(kind), F.sha2(address, 256)))
        found = F.struct(F.lit(p.name).alias("publisher"), address.alias("canonical"), own.alias("article_id"), key.alias("article_key"))
        out = F.when(address.isNotNull(), found).otherwise(out)
    return out
