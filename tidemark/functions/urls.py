"""URL functions as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query keys that only track. Fixed values.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref", "referrer", "source", "channel", "_t", "timestamp", "_", "random", "share_token", "share_id", "share_from")
#: Further keys of one platform. Fixed values.
PLATFORM_TRACKING = {"weibo": ("band_rank", "refer", "t")}


def normalize_url(url: Column, platform: Column | None = None) -> Column:
    """UR-1: without a query as it is; else without tracking keys, those of the platform too, and fragment, keys in order."""
    key = lambda p: F.lower(F.split_part(p, F.lit("="), F.lit(1)))
    tracks = lambda p: key(p).isin(*TRACKING)
    if platform is not None:
        tracks = lambda p, all_=tracks: reduce(Column.__or__, [(platform == k) & key(p).isin(*v) for k, v in PLATFORM_TRACKING.items()], all_(p))
    base, query = F.split_part(url, F.lit("?"), F.lit(1)), F.regexp_extract(url, r"\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: (p != "") & ~tracks(p))
    ordered = F.transform(F.sort_array(F.transform(pairs, lambda p: F.struct(F.split_part(p, F.lit("="), F.lit(1)).alias("k"), p.alias("p")))), lambda s: s["p"])
    kept = F.array_join(ordered, "&")
    return F.when(query == "", url).when(kept == "", base).otherwise(F.concat(base, F.lit("?"), kept))


def host(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), r"^https?://([^/?#:]+)", 1)


def canonical_url(url: Column) -> Column:
    """UR-2: scheme, host and path in lower case, without query, fragment and last slash."""
    path = F.regexp_replace(F.regexp_extract(url, r"^https?://[^/?#]+([^?#]*)", 1), "/+$", "")
    return F.concat(F.lit("https://"), host(url), F.lower(path))


#: What may end the last part of a path, after a dash or alone. Fixed values.
UUID_END = "(?:^|-)([0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12})$"
HEX_END = "(?:^|-)([0-9a-f]{8,40})$"


def article_id(url: Column) -> Column:
    """UR-4: the UUID that ends the last part of the path, else the 8 to 40 hex digits that do, else nothing."""
    slug = F.regexp_extract(canonical_url(url), "^https://[^/]*(?:/.*)?/([^/]*)$", 1)
    long = F.regexp_extract(slug, UUID_END, 1)
    return F.when(long != "", long).otherwise(F.regexp_extract(slug, HEX_END, 1))


def article_key(url: Column) -> Column:
    """UR-5: the id, or the digest of the canonical url."""
    return F.when(article_id(url) != "", F.concat(F.lit("id:"), article_id(url))).otherwise(F.concat(F.lit("url:"), F.sha2(canonical_url(url), 256)))


def uuid_of(text: Column) -> Column:
    """UR-6: a UUID of the form of version 4 from the digest."""
    h = F.sha2(text, 256)
    at = lambda a, n: F.substring(h, a, n)
    variant = F.substring(F.lit("89ab"), (F.conv(at(17, 1), 16, 10).cast("int") % 4 + 1), F.lit(1))
    return F.concat_ws("-", at(1, 8), at(9, 4), F.concat(F.lit("4"), at(14, 3)), F.concat(variant, at(18, 3)), at(21, 12))
