"""Queries of topics, tokens, platforms and periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions.scores import WEIGHT_SQL, weight
from tidemark.plans import rules as K
from tidemark.plans.catalog import query
from tidemark.sources import tables as S
from tidemark.sources.tables import with_

TOPIC, START, END = "the", "2024-01-24", "2024-01-30"
_STOP, _AUTO_STOP = (", ".join(f"'{w}'" for w in of) for of in (X.STOP_WORDS, X.AUTO_STOP_WORDS))


def _tokens_sql(column: str = "title") -> str:
    return rf"list_filter(regexp_extract_all(regexp_replace({column}, 'https?://[^ ]+', '', 'g'), '[\p{{L}}\p{{N}}_]+'), lambda w: length(w) >= 2 AND w NOT IN ({_STOP}))"


def _date():
    return F.col("date").cast("string").alias("date")


def _between(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.col("date").between(F.lit(a).cast("date"), F.lit(b).cast("date")))


def daily_counts(spark: SparkSession, titles: DataFrame, topic: str, start: str, end: str) -> DataFrame:
    """AG-7: titles that hold the topic, by day, with zeros."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))
    hits = _between(titles, start, end).where(X.matches(F.col("title"), topic)).groupBy("date").agg(F.count("*").alias("c"))
    return days.join(hits, "date", "left").select("date", F.coalesce("c", F.lit(0)).alias("c"))


_SERIES = f""", days AS (SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY)) AS DATE) AS date),
series AS (SELECT d.date, count(t.title) AS c FROM days d LEFT JOIN (SELECT * FROM titles WHERE contains(lower(title), '{TOPIC}')) t ON t.date = d.date GROUP BY 1) """


@query(with_("titles", body=_SERIES + "SELECT CAST(date AS VARCHAR) AS date, c FROM series"))
def topic_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TD-1, AG-7, FL-3: mentions of a topic by day."""
    return daily_counts(spark, S.titles(spark, sf_dir), TOPIC, START, END).select(_date(), "c")


@query(with_("titles", body=_SERIES + """, s AS (SELECT sum(c)::BIGINT AS total, round(avg(c), 2) AS mean, max(c) AS peak, arg_max(date, (c, -epoch(date))) AS peak_date, arg_min(c, date) FILTER (c > 0) AS first_c, arg_max(c, date) AS last_c FROM series)
SELECT total, mean, peak, CAST(peak_date AS VARCHAR) AS peak_date, round(CASE WHEN first_c IS NULL THEN 0.0 ELSE 100.0 * (last_c - first_c) / first_c END, 2) AS change_rate,
CASE WHEN first_c IS NULL THEN 'stable' WHEN 100.0 * (last_c - first_c) / first_c > 10 THEN 'up' WHEN 100.0 * (last_c - first_c) / first_c < -10 THEN 'down' ELSE 'stable' END AS direction FROM s"""))
def topic_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-8, WN-8: total, mean, peak and change of a topic's days."""
    s = daily_counts(spark, S.titles(spark, sf_dir), TOPIC, START, END)
    first = F.min_by(F.when(F.col("c") > 0, F.col("c")), F.when(F.col("c") > 0, F.col("date")))
    one = s.agg(F.sum("c").alias("total"), F.round(F.avg("c"), 2).alias("mean"), F.max("c").alias("peak"), F.max_by("date", F.struct("c", -F.unix_date("date"))).alias("peak_date"), first.alias("first_c"), F.max_by("c", "date").alias("last_c"))
    rate = F.coalesce((F.col("last_c") - F.col("first_c")) * 100.0 / F.col("first_c"), F.lit(0.0))
    return one.select("total", "mean", "peak", F.col("peak_date").cast("string").alias("peak_date"), F.round(rate, 2).alias("change_rate"), F.when(rate > 10, "up").when(rate < -10, "down").otherwise("stable").alias("direction"))


@query(with_("titles", body=_SERIES + """, r AS (SELECT *, row_number() OVER (ORDER BY date) AS a, row_number() OVER (ORDER BY date DESC) AS z FROM series),
s AS (SELECT min(date) FILTER (c > 0) AS first_seen, max(date) FILTER (c > 0) AS last_seen, max(c) AS peak, count(*) FILTER (c > 0) AS active, count(*) AS days, avg(c) FILTER (c > 0) AS mean, sum(c) FILTER (a <= 3) AS early, sum(c) FILTER (z <= 3) AS recent, max(c) FILTER (z <= 3) AS recent_max FROM r)
SELECT CAST(first_seen AS VARCHAR) AS first_seen, CAST(last_seen AS VARCHAR) AS last_seen, peak, active, round(mean, 2) AS mean, CASE WHEN recent > early THEN 'rising' WHEN recent < 0.5 * early THEN 'declining' WHEN recent_max = peak THEN 'burst' ELSE 'stable' END AS stage,
CASE WHEN active <= 2 AND peak > 2 * mean THEN 'flash' WHEN active >= 0.6 * days THEN 'sustained' ELSE 'periodic' END AS kind FROM s"""))
def topic_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TD-2, AG-9, WN-5: stage and kind of a topic, from the first and last three days."""
    s = daily_counts(spark, S.titles(spark, sf_dir), TOPIC, START, END)
    day, end, start = F.col("date"), F.lit(END).cast("date"), F.lit(START).cast("date")
    c, on = F.col("c"), F.col("c") > 0
    late, soon = day > F.date_sub(end, 3), day < F.date_add(start, 3)
    one = s.agg(F.min(F.when(on, day)).alias("first_seen"), F.max(F.when(on, day)).alias("last_seen"), F.max(c).alias("peak"), F.count_if(on).alias("active"), F.count("*").alias("days"), F.avg(F.when(on, c)).alias("mean"), F.sum(F.when(soon, c)).alias("early"), F.sum(F.when(late, c)).alias("recent"), F.max(F.when(late, c)).alias("recent_max"))
    stage = F.when(F.col("recent") > F.col("early"), "rising").when(F.col("recent") < 0.5 * F.col("early"), "declining").when(F.col("recent_max") == F.col("peak"), "burst").otherwise("stable")
    kind = F.when((F.col("active") <= 2) & (F.col("peak") > 2 * F.col("mean")), "flash").when(F.col("active") >= 0.6 * F.col("days"), "sustained").otherwise("periodic")
    return one.select(F.col("first_seen").cast("string").alias("first_seen"), F.col("last_seen").cast("string").alias("last_seen"), "peak", "active", F.round("mean", 2).alias("mean"), stage.alias("stage"), kind.alias("kind"))


def token_days(titles: DataFrame, start: str, end: str) -> DataFrame:
    """AG-13: bag counts of tokens by day."""
    return _between(titles, start, end).select("date", F.explode(X.tokens_analytics(F.col("title"))).alias("word")).groupBy("date", "word").agg(F.count("*").alias("c"))


_BAG = f", tok AS (SELECT date, source_id, title, unnest({_tokens_sql()}) AS word FROM titles), bag AS (SELECT date, word, count(*) AS c FROM tok GROUP BY 1, 2) "


@query(with_("titles", body=_BAG + "SELECT word, sum(c)::BIGINT AS c FROM bag GROUP BY 1"))
def keyword_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-13, TX-4: how often each token occurs."""
    return token_days(S.titles(spark, sf_dir), "2000-01-01", "2100-01-01").groupBy("word").agg(F.sum("c").alias("c"))


@query(with_("titles", body=_BAG + f""", x AS (SELECT a.word, a.c AS cur, coalesce(b.c, 0) AS prev FROM (SELECT * FROM bag WHERE date = DATE '{END}') a LEFT JOIN (SELECT * FROM bag WHERE date = DATE '{END}' - 1) b USING (word))
SELECT word, cur, prev, CASE WHEN prev = 0 THEN 'new' ELSE 'growth' END AS kind, round(CASE WHEN prev = 0 THEN cur ELSE cur / prev END, 2) AS growth, CASE WHEN prev = 0 OR cur / prev > 4 THEN 'high' ELSE 'medium' END AS alert FROM x WHERE (prev = 0 AND cur >= 5) OR (prev > 0 AND cur / prev >= 2)"""))
def viral_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TD-3, JN-13, OR-11: tokens that grew at least twofold since the day before, or are new with five or more."""
    t = S.titles(spark, sf_dir)
    one = token_days(t, END, END).select("word", F.col("c").alias("cur"))
    two = token_days(t, "2024-01-29", "2024-01-29").select("word", F.col("c").alias("prev"))
    x = one.join(two, "word", "left").withColumn("prev", F.coalesce("prev", F.lit(0)))
    new, growth = F.col("prev") == 0, F.try_divide("cur", "prev")
    out = x.where((new & (F.col("cur") >= 5)) | (~new & (growth >= 2)))
    return out.select("word", "cur", "prev", F.when(new, "new").otherwise("growth").alias("kind"), F.round(F.when(new, F.col("cur").cast("double")).otherwise(growth), 2).alias("growth"), F.when(new | (growth > 4), "high").otherwise("medium").alias("alert"))


@query(with_("titles", body=_BAG + f""", g AS (SELECT word, date, c, lag(c) OVER (PARTITION BY word ORDER BY date) AS before, lead(c) OVER (PARTITION BY word ORDER BY date) AS after, count(*) OVER (PARTITION BY word) AS n FROM bag WHERE date BETWEEN DATE '{END}' - 3 AND DATE '{END}'),
s AS (SELECT word, any_value(n) AS n, min(c - before) AS step, arg_max(c, date) AS last_c, arg_max(before, date) AS prev_c FROM g GROUP BY 1)
SELECT word, last_c AS current, round(100.0 * (last_c - prev_c) / prev_c, 2) AS growth, CASE WHEN n = 2 THEN 0.6 WHEN step >= 0 THEN 0.9 ELSE 0.7 END AS confidence FROM s WHERE n >= 2 AND (last_c - prev_c) / prev_c > 0.3 AND CASE WHEN n = 2 THEN 0.6 WHEN step >= 0 THEN 0.9 ELSE 0.7 END >= 0.7"""))
def predict_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TD-4, WN-6, WN-7, OR-12: growth from the day before on which a token occurred, and how steady it is."""
    points = token_days(S.titles(spark, sf_dir), "2024-01-27", END).groupBy("word").agg(F.sort_array(F.collect_list(F.struct("date", "c"))).alias("p")).where(F.size("p") >= 2)
    at = lambda i: F.try_element_at("p", F.lit(i))["c"]  # noqa: E731  filters may be merged, so one day's token gets here too
    c = F.transform("p", lambda x: x["c"])
    falls = F.exists(F.zip_with(F.slice(c, 2, 9), F.slice(c, 1, 9), lambda b, a: b < a), lambda x: F.coalesce(x, F.lit(False)))
    confidence = F.when(F.size("p") == 2, 0.6).when(~falls, 0.9).otherwise(0.7)
    growth = (at(-1) - at(-2)) / at(-2)
    return points.where((growth > 0.3) & (confidence >= 0.7)).select("word", at(-1).alias("current"), F.round(growth * 100.0, 2).alias("growth"), confidence.alias("confidence"))


@query(with_("titles", body=f" SELECT source_id, count(*) AS total_news, count(*) FILTER (contains(lower(title), '{TOPIC}')) AS topic_mentions, count(DISTINCT title) AS n_titles, round(100.0 * count(*) FILTER (contains(lower(title), '{TOPIC}')) / count(*), 2) AS coverage FROM titles GROUP BY 1"))
def platform_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TD-5, AG-10: mentions and coverage of a topic by platform."""
    hit = F.count_if(X.matches(F.col("title"), TOPIC))
    return S.titles(spark, sf_dir).groupBy("source_id").agg(F.count("*").alias("total_news"), hit.alias("topic_mentions"), F.count_distinct("title").alias("n_titles"), F.round(hit * 100.0 / F.count("*"), 2).alias("coverage"))


_TOP = ", ranked AS (SELECT source_id, word, c, row_number() OVER (PARTITION BY source_id ORDER BY c DESC, word) AS k FROM (SELECT source_id, word, count(*) AS c FROM tok GROUP BY 1, 2)) "


def top_keywords(titles: DataFrame, key: str, n: int) -> DataFrame:
    """OR-8: the n most frequent tokens of each key; ties by the token."""
    c = titles.select(key, F.explode(X.tokens_analytics(F.col("title"))).alias("word")).groupBy(key, "word").agg(F.count("*").alias("c"))
    return c.withColumn("k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("c"), "word"))).where(F.col("k") <= n)


@query(with_("titles", body=_BAG + _TOP + "SELECT source_id, word, c, k::INT AS k FROM ranked WHERE k <= 5"))
def platform_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-10, OR-8: each platform's five most frequent tokens."""
    return top_keywords(S.titles(spark, sf_dir), "source_id", 5)


@query(with_("titles", body=_BAG + _TOP + "SELECT source_id, word FROM (SELECT *, count(*) OVER (PARTITION BY word) AS n FROM ranked WHERE k <= 40) WHERE n = 1"))
def unique_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-11, SO-4: tokens among the first 40 of one platform alone."""
    top = top_keywords(S.titles(spark, sf_dir), "source_id", 40)
    alone = top.groupBy("word").agg(F.count("*").alias("n")).where("n = 1")
    return top.join(alone, "word", "left_semi").select("source_id", "word")


@query(with_("obs", "batches", "titles", body=""", t AS (SELECT source_id, count(*) AS news_count, count(DISTINCT date) AS days_active FROM titles GROUP BY 1), b AS (SELECT source_id, count(*) AS total_updates FROM batches GROUP BY 1),
h AS (SELECT source_id, string_agg(h, ',' ORDER BY k) AS top_hours FROM (SELECT source_id, h, row_number() OVER (PARTITION BY source_id ORDER BY c DESC, h) AS k FROM (SELECT source_id, strftime(crawl_ts, '%H') AS h, count(*) AS c FROM obs GROUP BY 1, 2)) WHERE k <= 3 GROUP BY 1)
SELECT source_id, news_count, days_active, total_updates, round(news_count / days_active, 2) AS per_day, top_hours FROM t JOIN b USING (source_id) JOIN h USING (source_id)"""))
def platform_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TD-5, AG-12: news, days, updates and busiest hours by platform."""
    t = S.titles(spark, sf_dir).groupBy("source_id").agg(F.count("*").alias("news_count"), F.count_distinct("date").alias("days_active"))
    b = S.batches(spark, sf_dir).groupBy("source_id").agg(F.count("*").alias("total_updates"))
    hours = S.obs(spark, sf_dir).groupBy("source_id", F.date_format("crawl_ts", "HH").alias("h")).agg(F.count("*").alias("c"))
    top = hours.groupBy("source_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("c")).alias("c"), "h"))).alias("p"))
    top = top.select("source_id", F.array_join(F.transform(F.slice("p", 1, 3), lambda x: x["h"]), ",").alias("top_hours"))
    return t.join(b, "source_id").join(top, "source_id").select("source_id", "news_count", "days_active", "total_updates", F.round(F.col("news_count") / F.col("days_active"), 2).alias("per_day"), "top_hours")


@query(with_("titles", body=f""", one AS (SELECT date, source_id, title, {_tokens_sql()} AS w FROM titles WHERE date = DATE '{END}'), p AS (SELECT date, source_id, title, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM one)
SELECT least(a.word, b.word) AS word_a, greatest(a.word, b.word) AS word_b, count(*) AS c FROM p a JOIN p b USING (date, source_id, title) WHERE a.i < b.i GROUP BY 1, 2 HAVING count(*) >= 3"""))
def cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-15, JN-15: pairs of tokens in a title; a title has a bounded number of tokens, so its pairs are made in its row."""
    words = _between(S.titles(spark, sf_dir), END, END).select(X.tokens_analytics(F.col("title")).alias("w"))
    pairs = F.flatten(F.transform("w", lambda a, i: F.transform(F.slice("w", i + 2, F.greatest(F.size("w"), F.lit(1))), lambda b: F.struct(F.least(a, b).alias("word_a"), F.greatest(a, b).alias("word_b")))))
    return words.select(F.inline(pairs)).groupBy("word_a", "word_b").agg(F.count("*").alias("c")).where("c >= 3")


@query(with_("titles", body=f", g AS (SELECT {K.any_sql(K.RULES)} AS keyword, title FROM titles) SELECT keyword, count(*) AS frequency, count(DISTINCT title) AS matched_news FROM g WHERE keyword IS NOT NULL GROUP BY 1"))
def trending_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-14: titles by the first group of which any word matches."""
    g = S.titles(spark, sf_dir).withColumn("keyword", K.any_group_of(K.RULES, F.col("title"))).where("keyword is not null")
    return g.groupBy("keyword").agg(F.count("*").alias("frequency"), F.count_distinct("title").alias("matched_news"))


@query(with_("titles", body=rf""", tok AS (SELECT title, unnest(list_filter(regexp_extract_all(title, '[\x{{4e00}}-\x{{9fff}}]{{2,}}|[a-zA-Z]{{2,}}[a-zA-Z0-9]*'), lambda w: lower(w) NOT IN ({_AUTO_STOP}))) AS keyword FROM titles)
SELECT keyword, count(*) AS frequency, count(DISTINCT title) AS matched_news FROM tok GROUP BY 1"""))
def trending_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-14, TX-6: keywords taken from the titles themselves."""
    g = S.titles(spark, sf_dir).select("title", F.explode(X.tokens_auto(F.col("title"))).alias("keyword"))
    return g.groupBy("keyword").agg(F.count("*").alias("frequency"), F.count_distinct("title").alias("matched_news"))


_P1, _P2 = ("2024-01-16", "2024-01-22"), ("2024-01-23", "2024-01-29")
_PERIOD = f"CASE WHEN date BETWEEN DATE '{_P1[0]}' AND DATE '{_P1[1]}' THEN 1 WHEN date BETWEEN DATE '{_P2[0]}' AND DATE '{_P2[1]}' THEN 2 END"


def _period():
    d = lambda x: F.lit(x).cast("date")
    return F.when(F.col("date").between(*map(d, _P1)), 1).when(F.col("date").between(*map(d, _P2)), 2)


_CHANGE = "c2 - c1 AS change, round(CASE WHEN c1 > 0 THEN 100.0 * (c2 - c1) / c1 WHEN c2 > 0 THEN 100.0 ELSE 0.0 END, 1) AS pct"


def _change(df: DataFrame) -> DataFrame:
    c1, c2 = F.col("c1"), F.col("c2")
    return df.withColumns({"change": c2 - c1, "pct": F.round(F.when(c1 > 0, F.try_divide((c2 - c1) * 100.0, c1)).when(c2 > 0, 100.0).otherwise(0.0), 1)})


@query(with_("titles", body=f", p AS (SELECT *, {_PERIOD} AS period FROM titles), x AS (SELECT count(*) FILTER (period = 1) AS c1, count(*) FILTER (period = 2) AS c2 FROM p) SELECT c1, c2, {_CHANGE} FROM x"))
def period_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TD-6, AG-19: news of two periods."""
    p = S.titles(spark, sf_dir).withColumn("period", _period())
    return _change(p.agg(F.count_if(F.col("period") == 1).alias("c1"), F.count_if(F.col("period") == 2).alias("c2")))


@query(with_("titles", body=_BAG + f", x AS (SELECT word, count(*) FILTER (period = 1) AS c1, count(*) FILTER (period = 2) AS c2 FROM (SELECT *, {_PERIOD} AS period FROM tok) WHERE period IS NOT NULL GROUP BY 1) SELECT word, c1, c2, {_CHANGE}, CASE WHEN c1 = 0 THEN 'new' WHEN c2 > c1 THEN 'rising' WHEN c2 < c1 THEN 'falling' ELSE 'same' END AS kind FROM x"))
def topic_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TD-6, JN-12, OR-13: tokens of two periods, joined in full."""
    p = S.titles(spark, sf_dir).withColumn("period", _period()).where("period is not null").select("period", F.explode(X.tokens_analytics(F.col("title"))).alias("word"))
    x = _change(p.groupBy("word").agg(F.count_if(F.col("period") == 1).alias("c1"), F.count_if(F.col("period") == 2).alias("c2")))
    return x.withColumn("kind", F.when(F.col("c1") == 0, "new").when(F.col("c2") > F.col("c1"), "rising").when(F.col("c2") < F.col("c1"), "falling").otherwise("same"))


@query(with_("titles", body=f", x AS (SELECT source_id, count(*) FILTER (period = 1) AS c1, count(*) FILTER (period = 2) AS c2 FROM (SELECT *, {_PERIOD} AS period FROM titles) GROUP BY 1) SELECT source_id, c1, c2, {_CHANGE} FROM x"))
def period_platforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TD-6: platforms of two periods."""
    p = S.titles(spark, sf_dir).withColumn("period", _period())
    return _change(p.groupBy("source_id").agg(F.count_if(F.col("period") == 1).alias("c1"), F.count_if(F.col("period") == 2).alias("c2")))


@query(with_("titles", body=_BAG + f""", k AS (SELECT period, word, row_number() OVER (PARTITION BY period ORDER BY c DESC, word) AS k FROM (SELECT {_PERIOD} AS period, word, count(*) AS c FROM tok GROUP BY 1, 2) WHERE period IS NOT NULL)
SELECT word, CASE WHEN min(period) = 2 THEN 'new' WHEN max(period) = 1 THEN 'disappeared' ELSE 'persistent' END AS kind FROM k WHERE k <= 30 GROUP BY 1"""))
def period_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SO-6: tokens among the first 30 of one period or of both."""
    top = top_keywords(S.titles(spark, sf_dir).withColumn("period", _period()).where("period is not null"), "period", 30)
    both = top.groupBy("word").agg(F.min("period").alias("a"), F.max("period").alias("z"))
    return both.select("word", F.when(F.col("a") == 2, "new").when(F.col("z") == 1, "disappeared").otherwise("persistent").alias("kind"))


@query(with_("titles", body=_BAG + f""", top AS (SELECT word, sum(c)::BIGINT AS c FROM bag WHERE date = DATE '{END}' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10),
s AS (SELECT source_id, title, coalesce((SELECT sum(c) FROM top WHERE contains(lower(title), lower(word))), 0)::BIGINT AS score FROM titles WHERE date = DATE '{END}') SELECT source_id, title, score FROM s ORDER BY score DESC, title, source_id LIMIT 5"""))
def summary_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TD-8, OR-10: five titles with the most of the day's ten first tokens."""
    t = S.titles(spark, sf_dir)
    top = token_days(t, END, END).orderBy(F.desc("c"), "word").limit(10).agg(F.collect_list(F.struct(F.lower("word").alias("w"), "c")).alias("top"))
    score = F.aggregate("top", F.lit(0).cast("long"), lambda a, x: a + F.when(F.contains(F.lower("title"), x["w"]), x["c"]).otherwise(0))
    return _between(t, END, END).crossJoin(F.broadcast(top)).select("source_id", "title", score.alias("score")).orderBy(F.desc("score"), "title", "source_id").limit(5)


_MERGED = ", m AS (SELECT source_id, title, list_sort(list_distinct(flatten(list(ranks)))) AS ranks, sum(n)::BIGINT AS n, count(*) AS days FROM titles GROUP BY 1, 2) "


def merged(titles: DataFrame) -> DataFrame:
    """AG-16: titles of a source over all days."""
    return titles.groupBy("source_id", "title").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ranks")))).alias("ranks"), F.sum("n").alias("n"), F.count("*").alias("days"))


@query(with_("titles", body=_MERGED + "SELECT source_id, title, array_to_string(ranks, ',') AS ranks, n, days FROM m"))
def cross_day_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-16, SO-1."""
    return merged(S.titles(spark, sf_dir)).withColumn("ranks", F.array_join(F.transform("ranks", lambda r: r.cast("string")), ","))


@query(with_("titles", body=_MERGED + f"SELECT source_id, title, round({WEIGHT_SQL}, 6) AS weight FROM m WHERE contains(lower(title), '{TOPIC}') ORDER BY weight DESC, title, source_id LIMIT 50"))
def sentiment_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TD-9, OR-6: the 50 weightiest titles of a topic, as a model would be given them."""
    m = merged(S.titles(spark, sf_dir)).where(X.matches(F.col("title"), TOPIC)).select("source_id", "title", F.round(weight(F.col("ranks"), F.col("n")), 6).alias("weight"))
    return m.orderBy(F.desc("weight"), "title", "source_id").limit(50)
