"""Articles that a page lists: from the data that its script carries, else from its anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import strip_tags
from tidemark.operators.rounds import checkpointed

#: Keys that may hold a title, a link and a description, the preferred first. Fixed values.
TITLES = ("headline", "title", "name", "displayName", "seoTitle")
LINKS = ("url", "link", "canonicalUrl", "articleUrl")
DESCRIPTIONS = ("summary", "description", "dek", "seoDescription", "standfirst")
#: Anchors with less text aren't titles.
LEAST_ANCHOR = 6


def _unescaped(text: Column) -> Column:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def script_data(html: Column) -> Column:
    """The page's data as a VARIANT; null without the script, or if that is no JSON. References inside a script are text; they are decoded where it is no JSON as it stands."""
    body = F.regexp_extract(html, r"""(?s)<script[^>]+id=["']__NEXT_DATA__["'][^>]*>(.*?)</script>""", 1)
    as_json = lambda x: F.try_parse_json(F.nullif(x, F.lit("")))
    return F.coalesce(as_json(body), as_json(_unescaped(body)))


def objects(data: DataFrame, key: str, value: str) -> DataFrame:
    """key, path, value of every object inside the VARIANTs, at any depth. A round goes one level down, for all rows at once."""
    spark = data.sparkSession
    nested = lambda df: df.where(F.expr(f"schema_of_variant({value}) LIKE 'OBJECT%' OR schema_of_variant({value}) LIKE 'ARRAY%'"))
    level = checkpointed(nested(data.select(key, F.lit("").alias("path"), value).where(F.col(value).isNotNull())))
    found = []
    while not level.isEmpty():
        found.append(level.where(F.expr(f"schema_of_variant({value}) LIKE 'OBJECT%'")))
        down = spark.sql(f"SELECT t.{key}, concat(t.path, '/', lpad(cast(c.pos AS string), 6, '0')) AS path, c.value AS {value} FROM {{t}} t, LATERAL variant_explode(t.{value}) c", t=level)
        level = checkpointed(nested(down))
    out = found[0] if found else level
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def _first(value: str, keys: tuple[str, ...]) -> Column:
    """The first of the keys that holds a string that isn't blank."""
    of = lambda k: F.expr(f"CASE WHEN schema_of_variant(variant_get({value}, '$.{k}')) = 'STRING' THEN variant_get({value}, '$.{k}', 'string') END")
    return F.coalesce(*[F.when(F.trim(of(k)) != "", of(k)) for k in keys])


def articles(pages: DataFrame, key: str, html: str) -> DataFrame:
    """SRC-12: key, link, title, description, kind: each link once, of the page's data (that which stands the highest), or of its anchors where the data has none."""
    data = objects(pages.select(key, script_data(F.col(html)).alias("data")), key, "data")
    named = data.select(key, "path", _first("data", TITLES).alias("title"), _unescaped(_first("data", LINKS)).alias("link"), F.coalesce(_first("data", DESCRIPTIONS), F.lit("")).alias("description"), F.expr("variant_get(data, '$.type', 'string')").alias("type"))
    named = named.where("title is not null and link rlike '^https?://'").where("type is null or lower(type) not like '%video%'")
    named = named.select(key, strip_tags(F.col("title")).alias("title"), "link", strip_tags(F.col("description")).alias("description"), F.struct(F.length("path"), "path").alias("place")).where("title <> ''")
    own = named.groupBy(key, "link").agg(F.min_by(F.struct("title", "description"), "place").alias("x")).select(key, "link", "x.title", "x.description", F.lit("data").alias("kind"))
    own = checkpointed(own)
    rest = pages.join(own.select(key).distinct(), key, "left_anti")
    anchors = rest.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"""(?s)<a\b[^>]*href=["'][^"']+["'][^>]*>.*?</a>"""), F.lit(0))).alias("place", "a"))
    anchors = anchors.select(key, "place", _unescaped(F.regexp_extract("a", r"""href=["']([^"']+)["']""", 1)).alias("link"), strip_tags(F.col("a")).alias("title")).where(F.length("title") >= LEAST_ANCHOR)
    listed = anchors.groupBy(key, "link").agg(F.min_by("title", "place").alias("title")).select(key, "link", "title", F.lit("").alias("description"), F.lit("anchor").alias("kind"))
    return own.unionByName(listed)
