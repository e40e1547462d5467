"""Queries of what pages list. Every second page is given the script that such pages carry, with the page's own title, address and text at several depths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import articles as A
from tidemark.plans.catalog import query
from tidemark.sources import page_data as P
from tidemark.sources import tables as S

_OPEN, _CLOSE = '<script id="__NEXT_DATA__" type="application/json">', "</script>"


@query("""WITH p AS (SELECT page_id, url, html, regexp_extract(html, '<title>([^<]*)</title>', 1) AS head, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS top FROM pages),
j AS (SELECT page_id, json_object('props', json_object('pageProps', json_object('main', json_object('title', head, 'headline', CASE WHEN page_id % 4 = 0 THEN ' ' ELSE top END, 'url', url, 'dek', top),
'more', json_array(json_object('name', top, 'link', url || '#2', 'deep', json_array(json_array(json_object('seoTitle', head, 'canonicalUrl', 'https://deep.example/' || page_id, 'summary', page_id)))), json_object('title', head, 'url', '/local'), json_object('type', 'VideoObject', 'name', 'v', 'url', url || '#v'), json_object('title', 'second', 'url', url)))), 'page', page_id) AS data FROM p WHERE page_id % 2 = 0),
o AS (SELECT page_id, t.fullkey, t.value AS v, t.id AS id FROM j, json_tree(j.data) t WHERE t.type = 'OBJECT'),
s AS (SELECT page_id, id, len(fullkey) AS depth, list_filter([v->>'headline', v->>'title', v->>'name', v->>'displayName', v->>'seoTitle'], lambda x: trim(coalesce(x, '')) <> '')[1] AS title,
list_filter([v->>'url', v->>'link', v->>'canonicalUrl', v->>'articleUrl'], lambda x: trim(coalesce(x, '')) <> '')[1] AS link,
coalesce(list_filter([CASE WHEN json_type(v, '$.summary') = 'VARCHAR' THEN v->>'summary' END, v->>'dek'], lambda x: trim(coalesce(x, '')) <> '')[1], '') AS description FROM o WHERE coalesce(v->>'type', '') <> 'VideoObject')
SELECT page_id, link, count(*) AS n, max(CASE WHEN title = 'second' THEN 1 ELSE 0 END) AS second, max(description <> '')::INT AS described FROM s WHERE title IS NOT NULL AND regexp_matches(link, '^https?://') GROUP BY 1, 2""")
def page_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-12: objects of the pages' data that have a title and a link, at any depth, by link."""
    data = P.objects(_with_script(spark, sf_dir).select("page_id", P.script_data(F.col("html")).alias("data")), "page_id", "data")
    named = data.select("page_id", P._first("data", P.TITLES).alias("title"), P._first("data", P.LINKS).alias("link"), P._first("data", P.DESCRIPTIONS).alias("description"), F.expr("variant_get(data, '$.type', 'string')").alias("type"))
    named = named.where("title is not null and link rlike '^https?://' and type is null")
    return named.groupBy("page_id", "link").agg(F.count("*").alias("n"), F.max(F.when(F.col("title") == "second", 1).otherwise(0)).alias("second"), F.max(F.col("description").isNotNull()).cast("int").alias("described"))


def _with_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = S.table(spark, sf_dir, "pages").withColumn("head", F.regexp_extract("html", "<title>([^<]*)</title>", 1)).withColumn("top", F.regexp_extract("html", "<h1>([^<]*)</h1>", 1))
    k, url = F.col("page_id"), F.col("url")
    main = F.struct(F.col("head").alias("title"), F.when(k % 4 == 0, " ").otherwise(F.col("top")).alias("headline"), url.alias("url"), F.col("top").alias("dek"))
    deep = F.array(F.array(F.struct(F.col("head").alias("seoTitle"), F.concat(F.lit("https://deep.example/"), k.cast("string")).alias("canonicalUrl"), k.alias("summary"))))
    first = F.to_json(F.struct(F.col("top").alias("name"), F.concat(url, F.lit("#2")).alias("link"), deep.alias("deep")))
    local, video, second = (F.to_json(F.struct(*[c.alias(n) for n, c in of.items()])) for of in ({"title": F.col("head"), "url": F.lit("/local")}, {"type": F.lit("VideoObject"), "name": F.lit("v"), "url": F.concat(url, F.lit("#v"))}, {"title": F.lit("second"), "url": url}))
    data = F.concat(F.lit('{"props":{"pageProps":{"main":'), F.to_json(main), F.lit(',"more":['), F.concat_ws(",", first, local, video, second), F.lit(']}},"page":'), k.cast("string"), F.lit("}"))
    script = F.when(k % 2 == 0, F.concat(F.lit(_OPEN), data, F.lit(_CLOSE))).otherwise("")
    return p.select("page_id", "url", F.concat("html", script).alias("html"))


@query()
def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-12: articles that pages list: from their data where there is some, from their anchors elsewhere."""
    return P.articles(_with_script(spark, sf_dir), "page_id", "html")


_HEX = "sha256(url)"
#: Addresses made of a page's own: what is put together, what is left of it, and the id that it has; by the page's number.
_KINDS = [
    ("'https://CN.wsj.com//articles/Some-Title-' || substr(h, 1, 12) || '/?mod=a&x=' || page_id", "'https://cn.wsj.com/articles/Some-Title-' || substr(h, 1, 12)", "substr(h, 1, 12)", "wsj"),
    ("'https://cn.wsj.com:443/articles/' || upper(substr(h, 1, 8)) || '-' || substr(h, 9, 4) || '-4' || substr(h, 13, 3) || '-a' || substr(h, 16, 3) || '-' || substr(h, 19, 12) || '#top'",
     "'https://cn.wsj.com/articles/' || upper(substr(h, 1, 8)) || '-' || substr(h, 9, 4) || '-4' || substr(h, 13, 3) || '-a' || substr(h, 16, 3) || '-' || substr(h, 19, 12)",
     "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 13, 3) || '-a' || substr(h, 16, 3) || '-' || substr(h, 19, 12)", "wsj"),
    ("'https://cn.wsj.com/articles/video/' || substr(h, 1, 12)", None, None, None),
    ("'https://www.economist.com/leaders/2024/02/' || lpad((1 + page_id % 31)::VARCHAR, 2, '0') || '/Name-' || page_id || '?utm_source=x'", "CASE WHEN page_id % 31 < 29 THEN 'https://www.economist.com/leaders/2024/02/' || lpad((1 + page_id % 31)::VARCHAR, 2, '0') || '/Name-' || page_id END", "CASE WHEN page_id % 4 = 1 THEN substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 13, 3) || '-a' || substr(h, 16, 3) || '-' || substr(h, 19, 12) ELSE '' END", "economist"),
    ("'https://www.economist.com/podcasts/2024/02/01/a'", None, None, None),
    ("'http://cn.wsj.com/articles/' || substr(h, 1, 12)", None, None, None),
    ("'https://cn.wsj.com/articles/no-id-' || page_id", "'https://cn.wsj.com/articles/no-id-' || page_id", "''", "wsj"),
]
_CASES = lambda i: "CASE page_id % 7 " + " ".join(f"WHEN {k} THEN {x[i]}" for k, x in enumerate(_KINDS) if x[i] is not None) + " END"
_PUBLISHER = "CASE page_id % 7 " + " ".join(f"WHEN {k} THEN '{x[3]}'" for k, x in enumerate(_KINDS) if x[3]) + " END"


@query(f"""WITH p AS (SELECT page_id, {_HEX} AS h FROM pages), c AS (SELECT page_id, {_PUBLISHER} AS publisher, {_CASES(1)} AS canonical, {_CASES(2)} AS article_id FROM p)
SELECT page_id, publisher, canonical, article_id, CASE WHEN article_id <> '' THEN publisher || ':' || article_id WHEN publisher = 'economist' THEN 'economist-url:' || sha256(canonical) ELSE 'url:' || sha256(canonical) END AS article_key FROM c WHERE canonical IS NOT NULL""")
def article_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR-2, UR-3, UR-4, UR-5, FL-12: addresses of two publishers in many forms, their ids and keys; those of films, other hosts and days that don't exist go."""
    p = S.table(spark, sf_dir, "pages").select("page_id", F.sha2("url", 256).alias("h"))
    given = F.expr(f"CASE WHEN page_id % 4 = 1 THEN concat(' ', upper({_KINDS[1][2]})) ELSE 'none' END")
    rows = p.select("page_id", A.identity(F.expr(_CASES(0).replace("::VARCHAR", "")), given).alias("x"))
    return rows.where("x is not null").select("page_id", "x.*")
