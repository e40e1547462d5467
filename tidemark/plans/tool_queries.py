"""Queries of the tools around reports: scans by day, dates in words, channels, feeds for delivery, tag updates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import channels as C
from tidemark.functions import dates as D
from tidemark.functions import text as X
from tidemark.functions import urls as U
from tidemark.operators import history as H
from tidemark.operators.splitting import split_column
from tidemark.plans import rules as K
from tidemark.plans.catalog import query
from tidemark.sources import sinks
from tidemark.sources import tables as S
from tidemark.sources.tables import with_

_AS_OF = date.fromisoformat(S.AS_OF_DATE)
_FEED_DAY = "2024-01-02"
_NAMES = {"click": "Clicks", "view": "Views", "error": ""}
_NAMES_SQL = "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in _NAMES.items()) + ") AS p(source_id, name)"


@query(with_("obs_titles", body=f""", k AS (SELECT source_id, title, item_key, list_aggregate(list(rank ORDER BY crawl_ts, item_key), 'string_agg', ',') AS ranks, row_number() OVER (PARTITION BY source_id, title ORDER BY max(event_id) DESC) AS k
FROM obs_titles WHERE crawl_date = DATE '{S.AS_OF_DATE}' GROUP BY source_id, title, item_key)
SELECT k.source_id, coalesce(nullif(name, ''), k.source_id) AS platform, title, item_key, ranks FROM k LEFT JOIN {_NAMES_SQL} ON p.source_id = k.source_id WHERE k = 1"""))
def day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-9, JN-3, WN-10: a day's items with their platform and all ranks; of equal titles of a source the last item holds."""
    o = S.obs_titles(spark, sf_dir).where(F.col("crawl_date") == F.lit(_AS_OF))
    points = F.sort_array(F.collect_list(F.struct("crawl_ts", "item_key", "rank")))
    items = o.groupBy("source_id", "title", "item_key").agg(H.joined(F.transform(points, lambda p: p["rank"])).alias("ranks"), F.max("event_id").alias("last"))
    one = items.withColumn("k", F.row_number().over(Window.partitionBy("source_id", "title").orderBy(F.desc("last")))).where("k = 1")
    names = spark.createDataFrame(list(_NAMES.items()), "source_id string, name string")
    joined = one.join(F.broadcast(names), "source_id", "left")
    return joined.select("source_id", F.coalesce(F.nullif("name", F.lit("")), "source_id").alias("platform"), "title", "item_key", "ranks")


@query(with_("rss", body=f" SELECT item_id, feed_id, 'Feed ' || feed_id AS feed, title, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at FROM rss WHERE CAST(published_at AS DATE) = DATE '{_FEED_DAY}'"))
def rss_day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10: a day's entries with their feed's name, the newest first."""
    r = S.rss(spark, sf_dir)
    feeds = r.select("feed_id").distinct().withColumn("feed", F.concat(F.lit("Feed "), "feed_id"))
    day = r.where(F.to_date("published_at") == F.lit(_FEED_DAY).cast("date")).join(feeds, "feed_id", "left")
    return day.orderBy(F.desc("published_at"), "item_id").select("item_id", "feed_id", "feed", "title", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"))


_NOT_ARTICLES = r"(?i)^(audio|podcast|video)(:| \||—| –)"


@query(with_("rss", body=f""", t AS (SELECT item_id, url, CASE item_id % 5 WHEN 0 THEN 'Audio: ' WHEN 1 THEN 'video | ' ELSE '' END || CASE WHEN item_id % 11 = 0 THEN repeat(title, 12) ELSE title END AS title FROM rss)
SELECT item_id, title FROM t WHERE trim(title) <> '' AND url <> '' AND length(title) <= 300 AND NOT regexp_matches(trim(title), '{_NOT_ARTICLES}')"""))
def item_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL-13: entries with title and link, no longer than allowed, that aren't sound or film."""
    i = F.col("item_id")
    title = F.concat(F.when(i % 5 == 0, "Audio: ").when(i % 5 == 1, "video | ").otherwise(""), F.when(i % 11 == 0, F.repeat("title", 12)).otherwise(F.col("title")))
    t = S.rss(spark, sf_dir).select("item_id", "url", title.alias("title"))
    return t.where((F.trim("title") != "") & (F.col("url") != "") & (F.length("title") <= 300) & ~F.trim("title").rlike(_NOT_ARTICLES)).select("item_id", "title")


@query(with_("obs_titles", body=", m AS (SELECT max(crawl_ts) AS d FROM obs_titles) SELECT source_id, title, crawl_time AS first_time, crawl_time AS last_time, 1 AS count, CAST(min(rank) AS VARCHAR) AS ranks FROM obs_titles, m WHERE crawl_ts = d GROUP BY source_id, title, crawl_time"))
def current_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PJ-3: titles of the current batch as if each were seen once, now."""
    now = H.latest(S.obs_titles(spark, sf_dir), "crawl_ts").groupBy("source_id", "title", "crawl_time").agg(F.min("rank").cast("string").alias("ranks"))
    return now.select("source_id", "title", F.col("crawl_time").alias("first_time"), F.col("crawl_time").alias("last_time"), F.lit(1).alias("count"), "ranks")


@query(with_("titles", body=f""", t AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY list_min(ranks), title) AS k FROM titles WHERE date = DATE '{S.AS_OF_DATE}')
SELECT source_id, '[' || source_id || '] (' || count(*) || ')' || chr(10) || string_agg(k || '. ' || title, chr(10) ORDER BY k) AS part FROM t WHERE k <= 20 GROUP BY source_id"""))
def prompt_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OR-17: each platform's first 20 titles, numbered, as a model is given them."""
    w = Window.partitionBy("source_id").orderBy(F.array_min("ranks"), "title")
    t = S.titles(spark, sf_dir).where(F.col("date") == F.lit(_AS_OF)).withColumn("k", F.row_number().over(w)).where("k <= 20")
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "title"))), lambda x: F.concat(x["k"].cast("string"), F.lit(". "), x["title"])), "\n")
    head = F.concat(F.lit("["), F.col("source_id"), F.lit("] ("), F.col("n").cast("string"), F.lit(")\n"), F.col("lines"))
    return t.groupBy("source_id").agg(F.count("*").alias("n"), lines.alias("lines")).select("source_id", head.alias("part"))


@query(with_("titles_doc", body=f""", r AS (SELECT source_id, count(*) AS n FROM titles_doc GROUP BY 1), s AS (SELECT * FROM (VALUES ('hot', TRUE), ('rss', FALSE), ('new', TRUE)) AS v(region, shown))
SELECT region, source_id, n FROM r CROSS JOIN s WHERE shown"""))
def shown_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL-14: regions of a report that its settings show."""
    n = S.titles_doc(spark, sf_dir).groupBy("source_id").agg(F.count("*").alias("n"))
    shown = [k for k, on in {"hot": True, "rss": False, "new": True}.items() if on]
    return n.select(F.explode(F.array(*map(F.lit, shown))).alias("region"), "source_id", "n")


_EXPRESSIONS = ("today", "yesterday", "this week", "last week", "this month", "last month", "last 3 days", "past 14 days", "最近7天", "上周")
_RANGES_SQL = """(VALUES ('today', D, D), ('yesterday', D - 1, D - 1), ('this week', date_trunc('week', D)::DATE, D), ('last week', date_trunc('week', D)::DATE - 7, date_trunc('week', D)::DATE - 1), ('this month', date_trunc('month', D)::DATE, D),
('last month', (date_trunc('month', D) - INTERVAL 1 MONTH)::DATE, date_trunc('month', D)::DATE - 1), ('last 3 days', D - 2, D), ('past 14 days', D - 13, D), ('最近7天', D - 6, D), ('上周', date_trunc('week', D)::DATE - 7, date_trunc('week', D)::DATE - 1)) AS r(words, a, b)""".replace("D,", "@,").replace("D)", "@)").replace("D -", "@ -").replace("@", f"DATE '{S.AS_OF_DATE}'")


@query(with_("titles", body=f" SELECT words, strftime(a, '%Y-%m-%d') AS first_day, strftime(b, '%Y-%m-%d') AS last_day, count(title) AS n FROM {_RANGES_SQL} LEFT JOIN titles ON date BETWEEN a AND b GROUP BY 1, 2, 3"))
def date_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DT-1, DT-2: titles in ranges given in words. Titles are counted by day first, so few rows meet the ranges."""
    ranges = spark.createDataFrame([(x, *D.range_of(x, _AS_OF)) for x in _EXPRESSIONS], "words string, a date, b date")
    days = S.titles(spark, sf_dir).groupBy("date").agg(F.count("*").alias("n"))
    met = F.broadcast(ranges).join(days, F.col("date").between(F.col("a"), F.col("b"))).groupBy("words").agg(F.sum("n").alias("n"))
    return ranges.join(met, "words", "left").select("words", F.col("a").cast("string").alias("first_day"), F.col("b").cast("string").alias("last_day"), F.coalesce("n", F.lit(0)).alias("n"))


@query(with_("rss", body=" SELECT item_id, CASE WHEN item_id % 4 < 3 THEN strftime(date_trunc('second', published_at), '%Y-%m-%d %H:%M:%S') END AS parsed FROM rss"))
def feed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DT-8: dates as feeds write them: in mail's format, in ISO's with Z or an offset, or not at all."""
    t = S.rss(spark, sf_dir)
    kind, at = F.col("item_id") % 4, F.col("published_at")
    east = F.concat(F.date_format(at + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    text = F.when(kind == 0, F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).when(kind == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(kind == 2, east).otherwise("no date")
    return t.select("item_id", F.date_format(D.feed_date(text), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


_DAYS = {"today": 0, "yesterday": 1, "day before yesterday": 2, "3 days ago": 3, "大前天": 3, "10天前": 10, "last monday": 8, "this friday": 4, "上周日": 2, "本周一": 1, "2024-01-05": 25, "1月15日": 15, "1/20": 10, "2024年1月2日": 28}
_DAYS_SQL = "(VALUES " + ", ".join(f"('{k}', DATE '{S.AS_OF_DATE}' - {n})" for k, n in _DAYS.items()) + ") AS r(words, a)"


@query(with_("titles", body=f" SELECT words, strftime(a, '%Y-%m-%d') AS day, source_id, count(*) AS n FROM {_DAYS_SQL} JOIN titles ON date = a GROUP BY 1, 2, 3"))
def days_in_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DT-1: titles of single days given in words."""
    days = spark.createDataFrame([(x, D.date_of(x, _AS_OF)) for x in _DAYS], "words string, date date")
    counts = S.titles(spark, sf_dir).groupBy("date", "source_id").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(days), "date").select("words", F.col("date").cast("string").alias("day"), "source_id", "n")


_PRESETS = {"today": (0, 0), "yesterday": (1, 1), "last_week": (7, 1), "last_month": (30, 1), "this_week": (1, 0), "this_month": (29, 0)}
_PRESETS_SQL = "(VALUES " + ", ".join(f"('{k}', DATE '{S.AS_OF_DATE}' - {a}, DATE '{S.AS_OF_DATE}' - {b})" for k, (a, b) in _PRESETS.items()) + ") AS r(preset, a, b)"


@query(with_("titles", body=f" SELECT preset, source_id, count(*) AS n, count(DISTINCT title) AS titles FROM {_PRESETS_SQL} JOIN titles ON date BETWEEN a AND b GROUP BY 1, 2"))
def date_presets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DT-3: periods of the comparison, where last week is the seven days before today."""
    ranges = spark.createDataFrame([(x, *D.preset(x, _AS_OF)) for x in _PRESETS], "preset string, a date, b date")
    return S.titles(spark, sf_dir).join(F.broadcast(ranges), F.col("date").between(F.col("a"), F.col("b"))).groupBy("preset", "source_id").agg(F.count("*").alias("n"), F.count_distinct("title").alias("titles"))


@query()
def plain_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX-12: whole texts without the marks of Markdown, addresses as they are."""
    t = S.table(spark, sf_dir, "documents").select("doc_id", F.col("text"), C.plain(F.col("text")).alias("plain"))
    return t.select("doc_id", (F.length("text") - F.length("plain")).alias("n_removed"), F.sha2("plain", 256).alias("sha256"))


@query()
def cut_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX-11: texts with a foot cut to 1,000 bytes: between characters, after lines, and with the foot kept."""
    foot = F.lit(f"\n\n> 更新时间：{S.AS_OF}")
    t = S.table(spark, sf_dir, "documents").select("doc_id", F.concat("text", foot).alias("text"))
    cuts = {"bytes": X.truncate_bytes(F.col("text"), 1000), "lines": X.truncate_lines(F.col("text"), 1000), "foot": X.truncate_before_foot(F.col("text"), 1000)}
    rows = t.select("doc_id", F.inline(F.array(*[F.struct(F.lit(k).alias("cut"), c.alias("text")) for k, c in cuts.items()])))
    return rows.select("doc_id", "cut", F.octet_length("text").alias("bytes"), F.sha2("text", 256).alias("sha256"))


_MARKDOWN = "'## ' || title || chr(10) || '> <font color=''red''>quoted</font>' || chr(10) || '> **bold** & ~~old~~' || chr(10) || '---' || chr(10) || chr(10) || chr(10) || chr(10) || '[link](https://a.example/x) `code`'"


def _markdown():
    return F.concat(F.lit("## "), "title", F.lit("\n> <font color='red'>quoted</font>\n> **bold** & ~~old~~\n---\n\n\n\n[link](https://a.example/x) `code`"))


@query(with_("titles_doc", body=f", m AS (SELECT doc_id, {_MARKDOWN} AS text FROM titles_doc) " + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS channel, {C.rewritten_sql('text', C.steps(k))} AS text FROM m" for k in C.DIALECTS) + f" UNION ALL SELECT doc_id, 'plain', {C.rewritten_sql('text', C.steps('plain'))} FROM m"))
def channel_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX-12, TX-14: a Markdown text as each channel takes it."""
    m = S.titles_doc(spark, sf_dir).select("doc_id", _markdown().alias("text"))
    kinds = F.array(*[F.struct(F.lit(k).alias("channel"), C.adapted(F.col("text"), k).alias("text")) for k in C.DIALECTS], F.struct(F.lit("plain").alias("channel"), C.plain(F.col("text")).alias("text")))
    return m.select("doc_id", F.inline(kinds))


def _line_sql(k: str) -> str:
    q = lambda x: "'" + x.replace("'", "''") + "'"
    of = C.LINES[k]
    link = q(of.link).replace("%1$s", "' || title || '").replace("%2$s", "' || url || '")
    return f"SELECT item_id, '{k}' AS channel, {q(of.source).replace('%s', chr(39) + ' || feed_id || ' + chr(39))} || CASE WHEN item_id % 2 = 0 THEN '🆕 ' ELSE '' END || CASE WHEN url <> '' THEN {link} ELSE title END || {q(of.time).replace('%s', chr(39) + ' || clock || ' + chr(39))} || CASE WHEN n > 1 THEN {q(of.count).replace('%d', chr(39) + ' || n || ' + chr(39))} ELSE '' END AS line FROM l"


@query(with_("rss", body=", l AS (SELECT item_id, feed_id, title, CASE WHEN item_id % 3 = 0 THEN '' ELSE url END AS url, strftime(published_at, '%H:%M') AS clock, item_id % 4 AS n FROM rss) " + " UNION ALL ".join(map(_line_sql, C.LINES))))
def channel_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX-15: the line of an entry in each channel."""
    r = S.rss(spark, sf_dir)
    i = F.col("item_id")
    url = F.when(i % 3 == 0, "").otherwise(F.col("url"))
    line = lambda k: C.title_line(k, F.col("title"), url, F.col("feed_id"), F.date_format("published_at", "HH:mm"), i % 4, i % 2 == 0)
    return r.select("item_id", F.inline(F.array(*[F.struct(F.lit(k).alias("channel"), line(k).alias("line")) for k in C.LINES])))


@query(with_("obs", body=""" SELECT crawl_date::VARCHAR AS crawl_date, source_id, item_key, string_agg(rank || '(' || crawl_time || ')', '→' ORDER BY crawl_ts) AS timeline,
CASE WHEN min(crawl_time) = max(crawl_time) THEN min(crawl_time) ELSE min(crawl_time) || '~' || max(crawl_time) END AS times FROM obs GROUP BY ALL"""))
def timeline_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX-17, DT-7: an item's ranks and times as text."""
    o = S.obs(spark, sf_dir).withColumn("time", D.clock(F.date_format("crawl_ts", "yyyy-MM-dd HH:mm:ss")))
    g = o.groupBy("crawl_date", "source_id", "item_key").agg(H.ordered("time", "rank").alias("p"), F.min("time").alias("a"), F.max("time").alias("b"))
    return g.select(F.col("crawl_date").cast("string").alias("crawl_date"), "source_id", "item_key", C.timeline_text(F.col("p")).alias("timeline"), C.time_range(F.col("a"), F.col("b")).alias("times"))


@query(" SELECT DISTINCT 'search:' || substr(md5('lang=' || lang || '&source=' || source), 1, 8) AS key, lang, source FROM documents")
def cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR-8: a key of a query's parameters, in order of their names."""
    d = S.table(spark, sf_dir, "documents").select("lang", "source").distinct()
    return d.select(F.concat(F.lit("search:"), F.substring(F.md5(F.concat(F.lit("lang="), "lang", F.lit("&source="), "source")), 1, 8)).alias("key"), "lang", "source")


@query(r""" WITH e AS (SELECT page_id, 'https://' || regexp_extract(lower(url), '^https?://([^/?#:]+)', 1) || lower(regexp_replace(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '/+$', '')) AS link FROM pages WHERE page_id % 7 <> 0)
SELECT link, min(page_id) AS page_id FROM e GROUP BY link""")
def delivery_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-14: a JSON feed to be delivered: films go, links become canonical, the first entry of a link holds."""
    p = S.table(spark, sf_dir, "pages").select("page_id", F.to_json(F.struct("page_id", "url", F.when(F.col("page_id") % 7 == 0, "video").otherwise("text").alias("kind"))).alias("body"))
    e = p.select(F.from_json("body", "page_id long, url string, kind string").alias("e")).select("e.*").where("kind <> 'video'")
    return e.groupBy(U.canonical_url(F.col("url")).alias("link")).agg(F.min("page_id").alias("page_id"))


_RULE_ROWS = [(i, g.name, g.most, " ".join(w.text for w in g.required), " ".join(w.text for w in g.normal)) for i, g in enumerate(K.RULES.groups)]


@query(" SELECT * FROM (VALUES (0, 'Attain', 5, 'the', 'tion nd'), (1, 'eau ment', 3, '', 'eau ment'), (2, 'German', 0, '', 'sch ein'), (3, 'Spanish', 0, '', 'ci[oó]n mente'), (4, 'Rest', 0, '', 'ing er')) AS r(position, name, most, required, normal)")
def rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-15, TX-1: the sample rules' groups as rows."""
    return spark.createDataFrame(_RULE_ROWS, "position int, name string, most int, required string, normal string")


_STATES = ("discovered", "fetch_pending", "fetched", "doc_created", "shared", "notified")
_STATE_SQL = "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 5 ELSE 0 END"


@query(f" WITH s AS (SELECT user_id, {_STATE_SQL} AS step, ts, event_type = 'error' AS failed FROM events), b AS (SELECT user_id, max(step) AS step, count(*) FILTER (failed) AS failures FROM s GROUP BY 1) SELECT user_id AS article_key, ({list(_STATES)})[step + 1] AS state, failures FROM b")
def article_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OX-1: an article's state is the furthest that its log of events has reached; it never goes back."""
    step = F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "click", 2).when(F.col("event_type") == "signup", 3).when(F.col("event_type") == "purchase", 5).otherwise(0)
    b = S.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("article_key")).agg(F.max(step).alias("step"), F.count_if(F.col("event_type") == "error").alias("failures"))
    return b.select("article_key", F.get(F.array(*map(F.lit, _STATES)), F.col("step")).alias("state"), "failures")




@query(""" WITH u AS (SELECT doc_id, doc_id % 4 = 0 AS first, least((doc_id % 15) / 10.0, 1.0) AS ratio FROM documents)
SELECT doc_id, CASE WHEN first THEN 'first' WHEN ratio >= 0.6 THEN 'full' ELSE 'incremental' END AS kind, round(ratio, 6) AS ratio, 't' || doc_id % 7 AS kept, 'n' || doc_id % 3 AS added FROM u""")
def tag_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AI-1, AI-4: a model's answer on changed interests: entries without a tag go, the ratio is clamped, and it decides whether all tags are made anew."""
    k = F.col("doc_id")
    body = F.concat(F.lit('{"keep":[{"tag":" t'), (k % 7).cast("string"), F.lit(' "},{"name":"x"}],"add":[{"tag":"n'), (k % 3).cast("string"), F.lit('"}],"change_ratio":'), ((k % 15) / 10).cast("string"), F.lit("}"))
    u = S.table(spark, sf_dir, "documents").select("doc_id", F.from_json(body, "keep array<struct<tag:string>>, add array<struct<tag:string>>, change_ratio double").alias("u"))
    tags = lambda c: F.array_join(F.transform(F.filter(c, lambda t: t["tag"].isNotNull()), lambda t: F.trim(t["tag"])), ",")
    ratio = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("u.change_ratio", F.lit(0.0))))
    return u.select("doc_id", F.when(k % 4 == 0, "first").when(ratio >= 0.6, "full").otherwise("incremental").alias("kind"), F.round(ratio, 6).alias("ratio"), tags(F.col("u.keep")).alias("kept"), tags(F.col("u.add")).alias("added"))


@query(" WITH a AS (SELECT url, page_id, row_number() OVER (ORDER BY page_id) AS k, count(*) OVER () AS n FROM pages WHERE page_id % 3 = 0) SELECT k::INT AS place, url, n - 5 AS skipped FROM a WHERE k <= 5")
def article_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AI-6: the first five of the asked articles are read, the others are counted as skipped."""
    asked = S.table(spark, sf_dir, "pages").where("page_id % 3 = 0").select("page_id", "url")
    five = asked.orderBy("page_id").limit(5).withColumn("place", F.row_number().over(Window.orderBy("page_id")))
    return five.crossJoin(F.broadcast(asked.agg((F.count("*") - 5).alias("skipped")))).select("place", "url", "skipped")


@query()
def split_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP-10: texts in parts of 1,000 bytes, between paragraphs, lines or characters."""
    parts = S.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(split_column(1000)(F.col("text"))).alias("part", "text"))
    return parts.select("doc_id", "part", F.octet_length("text").alias("bytes"), F.sha2("text", 256).alias("sha256"))


_ESCAPED = "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


@query(with_("rss", body=f""", r AS (SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY published_at DESC, item_id) AS k FROM rss), t AS (SELECT * FROM r WHERE k <= 30)
SELECT feed_id, 0 AS place, '<h2>' || {_ESCAPED.format('feed_id')} || ' (' || count(*) || ')</h2>' AS line FROM t GROUP BY feed_id
UNION ALL SELECT feed_id, k::INT, '<li><a href="' || {_ESCAPED.format('url')} || '">' || {_ESCAPED.format('title')} || '</a> <small>' || strftime(published_at, '%m-%d %H:%M') || '</small></li>' FROM t"""))
def report_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-5, SNK-6: the lines of a page of feeds, which `sinks.write_report` writes."""
    w = Window.partitionBy("feed_id").orderBy(F.desc("published_at"), "item_id")
    t = S.rss(spark, sf_dir).withColumn("k", F.row_number().over(w)).where("k <= 30")
    return sinks.report_lines(t, "feed_id", "k", "title", "url", F.date_format("published_at", "MM-dd HH:mm"))
