"""Queries of feeds, texts and urls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions import urls as U
from tidemark.plans import rules as K
from tidemark.plans.catalog import query
from tidemark.sources import feeds
from tidemark.sources import tables as S
from tidemark.sources.tables import with_

_Q = "'"


def _pub(name: str = "published_at"):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


_FIRST = ", one AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY item_id) AS k, row_number() OVER (ORDER BY published_at DESC, item_id) AS r FROM rss) "


@query(with_("rss", body=_FIRST + f", g AS (SELECT *, {K.sql(K.RULES)} AS position FROM one WHERE k = 1) SELECT position, count(*) AS count, round(count(*) * 100 / (SELECT count(*) FROM rss), 2) AS percentage, min(item_id) AS first_item FROM g WHERE position IS NOT NULL GROUP BY 1"))
def rss_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-5, RP-4, WN-9: entries by rule group, one for each url; the percentage is of all entries."""
    r = S.rss(spark, sf_dir)
    one = r.withColumn("k", F.row_number().over(Window.partitionBy("url").orderBy("item_id"))).where("k = 1")
    g = one.withColumn("position", K.group_of(K.RULES, F.col("title"), position=True)).where("position is not null")
    total = F.broadcast(r.agg(F.count("*").alias("total")))
    return g.groupBy("position").agg(F.count("*").alias("count"), F.min("item_id").alias("first_item")).crossJoin(total).select("position", "count", F.round(F.col("count") * 100 / F.col("total"), 2).alias("percentage"), "first_item")


@query(with_("rss", body=", r AS (SELECT feed_id, url, item_id, row_number() OVER (PARTITION BY feed_id ORDER BY published_at DESC, item_id) AS k FROM rss) SELECT feed_id, url, max(k)::INT AS rank FROM r GROUP BY 1, 2"))
def rss_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-1: place by publication in a feed; of equal urls the last place holds."""
    w = Window.partitionBy("feed_id").orderBy(F.desc("published_at"), "item_id")
    return S.rss(spark, sf_dir).withColumn("k", F.row_number().over(w)).groupBy("feed_id", "url").agg(F.max("k").alias("rank"))


@query(with_("rss", body=", one AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY published_at DESC, item_id) AS k FROM rss) SELECT item_id, feed_id, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at FROM one WHERE k = 1 ORDER BY one.published_at DESC, item_id LIMIT 50"))
def rss_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SE-6, OR-9: the newest 50 entries, one for each url."""
    w = Window.partitionBy("url").orderBy(F.desc("published_at"), "item_id")
    one = S.rss(spark, sf_dir).withColumn("k", F.row_number().over(w)).where("k = 1")
    return one.orderBy(F.desc("published_at"), "item_id").limit(50).select("item_id", "feed_id", _pub())


@query(with_("rss", body=", rss2 AS (SELECT * FROM rss WHERE published_at < TIMESTAMP '2024-01-02'), m AS (SELECT max(hour(published_at)) AS d FROM rss2) SELECT DISTINCT feed_id, url FROM rss2 rss, m WHERE hour(published_at) = d AND url <> '' AND NOT EXISTS (SELECT 1 FROM rss2 o WHERE o.feed_id = rss.feed_id AND o.url = rss.url AND hour(o.published_at) < d)"))
def rss_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-8: urls of the first day's last hour that their feed had not before; a blank url is never new."""
    r = S.rss(spark, sf_dir).where("published_at < timestamp '2024-01-02'").withColumn("d", F.hour("published_at"))
    marked = r.crossJoin(F.broadcast(r.agg(F.max("d").alias("top"))))
    old = marked.where("d < top").select("feed_id", "url").distinct()
    return marked.where("d = top and url <> ''").select("feed_id", "url").distinct().join(old, ["feed_id", "url"], "left_anti")


@query(with_("rss", body=""", k AS (SELECT *, CASE WHEN guid <> '' THEN guid ELSE url END AS key FROM rss WHERE guid <> '' OR url <> '')
SELECT feed_id, key, count(*) AS crawl_count, arg_max(title, (published_at, item_id)) AS title, strftime(min(published_at), '%Y-%m-%d %H:%M:%S') AS first_at, strftime(max(published_at), '%Y-%m-%d %H:%M:%S') AS last_at FROM k GROUP BY 1, 2"""))
def rss_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-7: the fold of a feed's entries by guid, else by url."""
    k = S.rss(spark, sf_dir).withColumn("key", F.when(F.col("guid") != "", F.col("guid")).otherwise(F.col("url"))).where("key <> ''")
    t = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return k.groupBy("feed_id", "key").agg(F.count("*").alias("crawl_count"), F.max_by("title", F.struct("published_at", "item_id")).alias("title"), t(F.min("published_at")).alias("first_at"), t(F.max("published_at")).alias("last_at"))


_AGE = f"(epoch(TIMESTAMP '{S.AS_OF}') - epoch(published_at)) / 86400"


@query(with_("rss", body=f" SELECT item_id, round({_AGE}, 4) AS age_days FROM rss WHERE {_AGE} <= CASE feed_id WHEN 'src0' THEN 20 ELSE 28 END"))
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL-6, DT-5: entries no older than their feed's limit."""
    r = S.rss(spark, sf_dir)
    age = (F.unix_timestamp(F.lit(S.AS_OF)).cast("double") - F.unix_micros("published_at") / 1e6) / 86400
    return r.withColumn("age", age).where(F.col("age") <= F.when(F.col("feed_id") == "src0", 20).otherwise(28)).select("item_id", F.round("age", 4).alias("age_days"))


@query(with_("rss", body=" SELECT feed_id, count(*) AS n FROM rss WHERE feed_id NOT IN ('src1', 'src2') GROUP BY 1"))
def suppressed_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL-2, FL-8: feeds that are not to be shown go."""
    r = S.rss(spark, sf_dir)
    off = spark.createDataFrame([("src1",), ("src2",)], "feed_id string")
    return r.join(F.broadcast(off), "feed_id", "left_anti").groupBy("feed_id").agg(F.count("*").alias("n"))


@query(with_("rss", body=", k AS (SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY item_id) AS pos FROM rss) SELECT feed_id, item_id, pos::INT AS pos FROM k WHERE pos <= 10"))
def feed_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-8: the first ten entries of each feed."""
    w = Window.partitionBy("feed_id").orderBy("item_id")
    return S.rss(spark, sf_dir).withColumn("pos", F.row_number().over(w)).where("pos <= 10").select("feed_id", "item_id", "pos")


@query(with_("rss", body=r""", h AS (SELECT feed_id, bool_or(regexp_extract(lower(url), '^https?://([^/?#:]+)', 1) NOT LIKE '%.example.%') AS foreign_host, bool_or(NOT starts_with(url, 'https://')) AS insecure, count(*) AS n FROM rss GROUP BY 1) SELECT feed_id, n, foreign_host, insecure, foreign_host OR insecure AS failed FROM h"""))
def source_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3, FL-12: a source with one link that is not secure, or of a foreign host, fails as a whole."""
    r = S.rss(spark, sf_dir).groupBy("feed_id").agg(F.bool_or(~U.host(F.col("url")).like("%.example.%")).alias("foreign_host"), F.bool_or(~F.col("url").startswith("https://")).alias("insecure"), F.count("*").alias("n"))
    return r.withColumn("failed", F.col("foreign_host") | F.col("insecure"))


@query(""" SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link FROM pages""")
def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-12: links of a page."""
    return S.table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("link"))


@query(with_("obs", "obs_titles", body=""", x AS (SELECT source_id, trim(title) AS title, row_number() OVER (PARTITION BY source_id ORDER BY crawl_ts, rank, item_key) AS pos FROM obs_titles WHERE crawl_date = DATE '2024-01-05')
SELECT source_id, title, array_to_string(list(pos ORDER BY pos), ',') AS ranks FROM x WHERE title <> '' GROUP BY 1, 2"""))
def hotlist_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1, SRC-2, SRC-4: JSON lists of a day, parsed; positions of each title."""
    day = S.obs_titles(spark, sf_dir).where("crawl_date = date '2024-01-05'")
    items = F.transform(F.sort_array(F.collect_list(F.struct("crawl_ts", "rank", "item_key", "title"))), lambda x: F.struct(x["title"].alias("title"), F.lit("https://list.example").alias("url")))
    raw = day.groupBy("source_id").agg(F.to_json(F.struct(F.lit("success").alias("status"), items.alias("items"))).alias("body"))
    return feeds.ranked_list(raw).select("source_id", "title", F.array_join(F.transform("ranks", lambda r: r.cast("string")), ",").alias("ranks"))


#: Entries go to bodies of so many ids, so that a busy feed is not one row.
_BODY = "floor(item_id / 500)"


@query(with_("rss", body=" SELECT feed_id, CASE WHEN item_id % 3 = 0 THEN substr(summary, 1, 20) || '...' ELSE trim(title) END AS title, CASE WHEN guid = '' THEN url ELSE guid END AS guid FROM rss WHERE CASE WHEN item_id % 3 = 0 THEN 'x' ELSE title END <> ''"))
def jsonfeed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6, SRC-7: JSON feeds, written and parsed; a third of the entries lack a title."""
    item = F.struct(F.col("guid").alias("id"), "url", F.when(F.col("item_id") % 3 != 0, F.col("title")).alias("title"), F.when((F.col("item_id") % 3 == 0), F.col("summary")).otherwise("").alias("summary"))
    raw = S.rss(spark, sf_dir).where("item_id % 3 = 0 or title <> ''").groupBy("feed_id", F.expr(_BODY).alias("body_no")).agg(F.to_json(F.struct(F.lit("https://jsonfeed.org/version/1.1").alias("version"), F.collect_list(item).alias("items"))).alias("body"))
    return feeds.json_feed(raw).select("feed_id", "title", "guid")


@query(with_("rss", body=" SELECT feed_id, url AS link, 'i' || item_id AS guid FROM rss WHERE feed_id <> 'src3'"))
def rss_xml_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5, SRC-13, SNK-7: RSS documents, written and parsed; one with a document type is refused."""
    esc = X.html_escape
    item = F.concat(F.lit("<item><title>"), esc(F.col("title")), F.lit("</title><link>"), esc(F.col("url")), F.lit("</link><guid>i"), F.col("item_id").cast("string"), F.lit("</guid></item>"))
    body = F.concat(F.when(F.col("feed_id") == "src3", F.lit("<!DOCTYPE rss>")).otherwise(F.lit("")), F.lit("<rss><channel><title>t</title>"), F.array_join(F.collect_list(item), ""), F.lit("</channel></rss>"))
    return feeds.rss_items(S.rss(spark, sf_dir).groupBy("feed_id", F.expr(_BODY).alias("body_no")).agg(body.alias("body"))).select("feed_id", "link", "guid")


@query(with_("rss", body=""", u AS (SELECT url, feed_id, item_id, CASE WHEN published_at >= TIMESTAMP '2024-01-02' THEN 0 ELSE 1 END AS old FROM rss WHERE published_at < TIMESTAMP '2024-01-03'),
k AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY old, item_id) AS k FROM u) SELECT url, feed_id, item_id, old FROM k WHERE k = 1 ORDER BY old, item_id LIMIT 80"""))
def last_known_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-22, SO-2: new entries, then those of the last good snapshot, one for each url, 80 in all."""
    r = S.rss(spark, sf_dir).where("published_at < timestamp '2024-01-03'").withColumn("old", F.when(F.col("published_at") >= F.lit("2024-01-02").cast("timestamp"), 0).otherwise(1))
    w = Window.partitionBy("url").orderBy("old", "item_id")
    return r.withColumn("k", F.row_number().over(w)).where("k = 1").select("url", "feed_id", "item_id", "old").orderBy("old", "item_id").limit(80)


@query(with_("rss", body=f" SELECT feed_id, count(*) AS items, CASE WHEN min({_AGE}) > 29 THEN 'stale' ELSE 'ok' END AS status FROM rss GROUP BY 1"))
def source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-29: entries of each feed and whether its newest is too old."""
    age = (F.unix_timestamp(F.lit(S.AS_OF)).cast("double") - F.unix_micros(F.max("published_at")) / 1e6) / 86400
    return S.rss(spark, sf_dir).groupBy("feed_id").agg(F.count("*").alias("items"), F.when(age > 29, "stale").otherwise("ok").alias("status"))


_TRACK = ", ".join(f"'{x}'" for x in U.TRACKING)


@query(rf""" WITH p AS (SELECT page_id, url, split_part(url, '?', 1) AS base, regexp_extract(url, '\?([^#]*)', 1) AS query FROM pages),
k AS (SELECT *, array_to_string(list_sort(list_filter(string_split(query, '&'), lambda x: x <> '' AND lower(split_part(x, '=', 1)) NOT IN ({_TRACK}))), '&') AS kept FROM p)
SELECT page_id, CASE WHEN query = '' THEN url WHEN kept = '' THEN base ELSE base || '?' || kept END AS url FROM k""")
def normalize_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR-1."""
    return S.table(spark, sf_dir, "pages").select("page_id", U.normalize_url(F.col("url")).alias("url"))


@query(rf""" WITH p AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'weibo' ELSE 'other' END AS platform, split_part(url, '#', 1) || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'q=' || page_id || '&band_rank=3&Refer=top&T=1' AS url FROM pages),
k AS (SELECT *, array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda x: x <> '' AND lower(split_part(x, '=', 1)) NOT IN ({_TRACK}) AND NOT (platform = 'weibo' AND lower(split_part(x, '=', 1)) IN ('band_rank', 'refer', 't')))), '&') AS kept FROM p)
SELECT page_id, platform, split_part(url, '?', 1) || '?' || kept AS url FROM k""")
def normalize_platform_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR-1: keys that only one platform has for tracking."""
    p = S.table(spark, sf_dir, "pages").withColumn("platform", F.when(F.col("page_id") % 2 == 0, "weibo").otherwise("other"))
    url = F.concat(F.substring_index("url", "#", 1), F.when(F.contains("url", F.lit("?")), "&").otherwise("?"), F.lit("q="), F.col("page_id").cast("string"), F.lit("&band_rank=3&Refer=top&T=1"))
    return p.select("page_id", "platform", U.normalize_url(url, F.col("platform")).alias("url"))


_CANON = r"'https://' || regexp_extract(lower(url), '^https?://([^/?#:]+)', 1) || lower(regexp_replace(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '/+$', ''))"
_SLUG = f"regexp_extract({_CANON}, '^https://[^/]*(?:/.*)?/([^/]*)$', 1)"
_ID = f"coalesce(nullif(regexp_extract({_SLUG}, '{U.UUID_END}', 1), ''), regexp_extract({_SLUG}, '{U.HEX_END}', 1))"


@query(f" SELECT page_id, {_CANON} AS canonical, {_ID} AS article_id, CASE WHEN {_ID} <> '' THEN 'id:' || {_ID} ELSE 'url:' || sha256({_CANON}) END AS article_key FROM pages")
def article_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR-2, UR-3, UR-4, UR-5: canonical urls, ids and keys."""
    u = F.col("url")
    return S.table(spark, sf_dir, "pages").select("page_id", U.canonical_url(u).alias("canonical"), U.article_id(u).alias("article_id"), U.article_key(u).alias("article_key"))


@query(""" WITH h AS (SELECT page_id, sha256(url) AS h FROM pages) SELECT page_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-' || substr('89ab', (instr('0123456789abcdef', substr(h, 17, 1)) - 1)::INT % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid FROM h""")
def message_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR-6."""
    return S.table(spark, sf_dir, "pages").select("page_id", U.uuid_of(F.col("url")).alias("uuid"))


_STOP, _AUTO_STOP = (", ".join(f"'{w}'" for w in of) for of in (X.STOP_WORDS, X.AUTO_STOP_WORDS))


@query(with_("titles_doc", body=rf""" SELECT doc_id, array_to_string(list_filter(regexp_extract_all(title, '[\p{{L}}\p{{N}}_]+'), lambda w: length(w) >= 2 AND w NOT IN ({_STOP})), ' ') AS a,
array_to_string(list_filter(regexp_extract_all(title, '[\p{{L}}\p{{N}}_]+'), lambda w: length(w) >= 2), ' ') AS b,
array_to_string(list_filter(regexp_extract_all(title, '[\x{{4e00}}-\x{{9fff}}]{{2,}}|[a-zA-Z]{{2,}}[a-zA-Z0-9]*'), lambda w: lower(w) NOT IN ({_AUTO_STOP})), ' ') AS c FROM titles_doc"""))
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX-4, TX-5, TX-6: the three tokenisers."""
    t = F.col("title")
    return S.titles_doc(spark, sf_dir).select("doc_id", *[F.array_join(f(t), " ").alias(n) for n, f in (("a", X.tokens_analytics), ("b", X.tokens_search), ("c", X.tokens_auto))])


@query(r""" SELECT doc_id, trim(regexp_replace(text, '[ \t\n\r]+', ' ', 'g')) AS clean, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS escaped,
CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS short, len(range(0, greatest(ceil(length(text) / 1500)::INT, 1))) AS n_chunks FROM documents""")
def text_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX-7, TX-9, TX-10, TX-20: cleaned, escaped, truncated and cut texts."""
    t = F.col("text")
    return S.table(spark, sf_dir, "documents").select("doc_id", X.clean_title(t).alias("clean"), X.html_escape(t).alias("escaped"), X.truncate(t, 100).alias("short"), F.size(X.chunks(t, 1500)).cast("long").alias("n_chunks"))


@query(r""" SELECT page_id, regexp_replace(regexp_replace('**' || page_id || '** [' || url || '](' || url || ')', '\[([^\]]+)\]\(([^)]+)\)', '<\2|\1>', 'g'), '\*\*([^*]+)\*\*', '*\1*', 'g') AS mrkdwn, regexp_replace('[' || url || '\]', '([\\\[\]])', '\\\1', 'g') AS escaped,
trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&'), '[ \t\n\r]+', ' ', 'g')) AS plain FROM pages""")
def markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX-8, TX-13, TX-21: Slack's Markdown, escapes, plain text of a page."""
    id_, u = F.col("page_id").cast("string"), F.col("url")
    return S.table(spark, sf_dir, "pages").select(
        "page_id", X.to_mrkdwn(F.concat(F.lit("**"), id_, F.lit("** ["), u, F.lit("]("), u, F.lit(")"))).alias("mrkdwn"), X.escape_markdown(F.concat(F.lit("["), u, F.lit("\\]"))).alias("escaped"), X.strip_tags(F.col("html")).alias("plain")
    )


@query(""" SELECT doc_id, 'interests.txt:' || md5(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '' AND NOT starts_with(x, '#')), chr(10))) AS hash FROM documents""")
def interest_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX-23: digest of a text without comments and blank lines."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("#"))
    return S.table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("interests.txt:"), F.md5(F.array_join(lines, "\n"))).alias("hash"))


@query(""" SELECT conv_id, turn, rtrim(split_part('n:' || turn || ' ' || text, '```', 1), ' ' || chr(10)) AS body FROM conversations""")
def fenced_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX-18: what a model's answer has in its fence, up to the first mark that closes it."""
    c = S.table(spark, sf_dir, "conversations")
    inner = F.concat(F.lit("n:"), F.col("turn").cast("string"), F.lit(" "), "text")
    return c.select("conv_id", "turn", X.fenced(F.concat(F.lit("Here:\n```json\n"), inner, F.lit("\n```\nDone"))).alias("body"))


@query(with_("rss", body=" SELECT item_id, strftime(published_at + INTERVAL 8 HOUR, '%m-%d %H:%M') AS shown, replace(strftime(published_at, '%H-%M'), '-', ':') AS clock FROM rss"))
def display_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DT-4, DT-6: times as shown eight hours east, and clock times."""
    return S.rss(spark, sf_dir).select("item_id", F.date_format(F.from_utc_timestamp("published_at", "Asia/Shanghai"), "MM-dd HH:mm").alias("shown"), F.replace(F.date_format("published_at", "HH-mm"), F.lit("-"), F.lit(":")).alias("clock"))
