"""Queries of search and similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions.scores import WEIGHT_SQL, weight
from tidemark.operators import similarity as M
from tidemark.plans.catalog import query
from tidemark.sources import tables as S
from tidemark.sources.tables import with_

WORD, ENTITY, DAY = "and", "The", S.AS_OF_DATE
_TOK_B = r"list_filter(regexp_extract_all(regexp_replace(regexp_replace({0}, 'https?://[^ ]+', '', 'g'), '\[[^\]]*\]', '', 'g'), '[\p{{L}}\p{{N}}_]+'), lambda w: length(w) >= 2)".format
_STOP = ", ".join(f"'{w}'" for w in X.STOP_WORDS)


def _date():
    return F.col("date").cast("string").alias("date")


@query(with_("titles", body=f" SELECT CAST(date AS VARCHAR) AS date, source_id, title, n, ranks[1] AS best_rank, round({WEIGHT_SQL}, 6) AS weight FROM titles WHERE contains(lower(title), '{WORD}') ORDER BY weight DESC, title, date, source_id LIMIT 50"))
def search_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SE-1, FL-3, OR-6: titles that hold a word, in any case, by weight."""
    hits = S.titles(spark, sf_dir).where(X.matches(F.col("title"), WORD))
    return hits.select(_date(), "source_id", "title", "n", F.array_min("ranks").alias("best_rank"), F.round(weight(F.col("ranks"), F.col("n")), 6).alias("weight")).orderBy(F.desc("weight"), "title", "date", "source_id").limit(50)


@query(with_("titles", body=f" SELECT CAST(date AS VARCHAR) AS date, source_id, title, n FROM titles WHERE contains(title, '{ENTITY}') ORDER BY date DESC, n DESC, title, source_id LIMIT 50"))
def search_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SE-1, FL-4: the same with case, by date."""
    return S.titles(spark, sf_dir).where(F.contains("title", F.lit(ENTITY))).select(_date(), "source_id", "title", "n").orderBy(F.desc("date"), F.desc("n"), "title", "source_id").limit(50)


@query(with_("titles", body=f" SELECT source_id, count(*) AS hits, round(avg(r), 2) AS mean_rank FROM (SELECT source_id, date, title, unnest(ranks) AS r FROM titles WHERE contains(lower(title), '{WORD}')) GROUP BY 1"))
def search_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SE-2, AG-17: hits and mean rank by platform, over all ranks."""
    return S.titles(spark, sf_dir).where(X.matches(F.col("title"), WORD)).select("source_id", F.explode("ranks").alias("r")).groupBy("source_id").agg(F.count("*").alias("hits"), F.round(F.avg("r"), 2).alias("mean_rank"))


@query(with_("titles", body=f" SELECT CAST(date AS VARCHAR) AS date, count(*) AS hits, count(DISTINCT source_id) AS sources FROM titles WHERE contains(lower(title), '{WORD}') GROUP BY titles.date"))
def search_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-18: hits by date."""
    return S.titles(spark, sf_dir).where(X.matches(F.col("title"), WORD)).groupBy(_date()).agg(F.count("*").alias("hits"), F.count_distinct("source_id").alias("sources"))


@query(with_("titles", body=rf""", tok AS (SELECT unnest(list_filter(regexp_extract_all(title, '[\p{{L}}\p{{N}}_]+'), lambda w: length(w) >= 2 AND w NOT IN ({_STOP}))) AS word FROM titles WHERE contains(title, '{ENTITY}'))
SELECT word, count(*) AS c FROM tok WHERE word <> '{ENTITY}' GROUP BY 1 ORDER BY c DESC, word LIMIT 10"""))
def entity_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SE-5: the ten tokens that go with an entity most often."""
    hits = S.titles(spark, sf_dir).where(F.contains("title", F.lit(ENTITY))).select(F.explode(X.tokens_analytics(F.col("title"))).alias("word"))
    return hits.where(F.col("word") != ENTITY).groupBy("word").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "word").limit(10)


@query(with_("titles", body=f" SELECT source_id, title, ranks[1] AS best_rank FROM titles WHERE date = DATE '{DAY}' ORDER BY best_rank, title, source_id LIMIT 50"))
def news_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OR-5, PJ-1: a day's titles by rank."""
    return S.titles(spark, sf_dir).where(F.col("date") == F.lit(DAY).cast("date")).select("source_id", "title", F.array_min("ranks").alias("best_rank")).orderBy("best_rank", "title", "source_id").limit(50)


@query(with_("rss", body=f" SELECT item_id, feed_id, CASE WHEN contains(lower(title), '{WORD}') THEN 'title' ELSE 'summary' END AS match_in FROM rss WHERE contains(lower(title), '{WORD}') OR contains(lower(summary), '{WORD}')"))
def search_rss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL-5, SE-6: entries that hold a word in the title or else in the summary."""
    hit = F.when(X.matches(F.col("title"), WORD), "title").when(X.matches(F.col("summary"), WORD), "summary")
    return S.rss(spark, sf_dir).withColumn("match_in", hit).where("match_in is not null").select("item_id", "feed_id", "match_in")


#: The stated queries of a search: titles of the rows whose id is divisible by this, against all rows.
EVERY = 20
_QUERIES = f"SELECT doc_id AS query_id, title AS ref FROM titles_doc WHERE doc_id % {EVERY} = 0 AND title <> ''"


def _asked(t: DataFrame) -> DataFrame:
    return t.where((F.col("doc_id") % EVERY == 0) & (F.col("title") != "")).select(F.col("doc_id").alias("query_id"), F.col("title").alias("ref"))


@query(with_("titles_doc", body=f""", q AS (SELECT query_id, list_distinct({_TOK_B('ref')}) AS b FROM ({_QUERIES})), t AS (SELECT doc_id, list_distinct({_TOK_B('title')}) AS a FROM titles_doc)
SELECT query_id, doc_id, round(len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))), 6) AS jaccard FROM q JOIN t ON list_has_any(a, b)"""))
def token_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIM-3, TX-5: similarity of the tokens of each title and each query that share one."""
    t = S.titles_doc(spark, sf_dir)
    return M.token_similar(_asked(t), t).withColumn("jaccard", F.round("jaccard", 6))


@query()
def similar_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIM-1, SIM-7, JN-17: sequence ratio to each query, in its own case."""
    t = S.titles_doc(spark, sf_dir)
    return M.similar(_asked(t), t, 0.4).withColumn("similarity", F.round("similarity", 3))


@query()
def similar_titles_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OR-7: each query's ten most similar titles."""
    t = S.titles_doc(spark, sf_dir)
    return M.most_similar(_asked(t), t, 0.4, 10).select("query_id", "place", "doc_id", F.round("similarity", 3).alias("similarity"))


@query()
def related_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SE-4, SIM-2, SIM-5: .7 of the lower-cased ratio and .3 of the token similarity."""
    t = S.titles_doc(spark, sf_dir)
    return M.related(_asked(t), t, 0.7, 0.3, 0.35).withColumn("score", F.round("score", 3))


@query()
def related_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SE-3, SIM-5: the same with the weights turned."""
    t = S.titles_doc(spark, sf_dir)
    return M.related(_asked(t), t, 0.3, 0.7, 0.25).withColumn("score", F.round("score", 4))


@query()
def fuzzy_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIM-4: holds the query; else the ratio; else half of the query's tokens."""
    t = S.titles_doc(spark, sf_dir)
    return M.fuzzy(_asked(t), t, 0.5).withColumn("score", F.round("score", 4))


@query()
def story_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIM-6, TD-7, AG-20, JN-16: near-equal titles around their weightiest one."""
    t = S.titles(spark, sf_dir).withColumn("weight", F.round(weight(F.col("ranks"), F.col("n")), 6))
    one = t.groupBy("title").agg(F.sum("n").alias("n"), F.max("weight").alias("weight"), F.min(F.array_min("ranks")).alias("best_rank"), F.sort_array(F.collect_set("source_id")).alias("sources"))
    return M.clusters(one, 0.7)


@query(with_("titles_doc", body=""", x AS (SELECT doc_id, length(title) AS n, list_sort(list_distinct(string_split(title, ''))) AS c FROM titles_doc WHERE title <> ''),
k AS (SELECT n, c, min(doc_id) AS class_id FROM x GROUP BY 1, 2),
l AS (SELECT a.class_id, count(*) AS n_links FROM k a JOIN k b ON a.class_id <> b.class_id AND least(a.n, b.n) >= 0.35 * greatest(a.n, b.n)
AND len(list_intersect(a.c, b.c)) >= 0.35 * (len(a.c) + len(b.c) - len(list_intersect(a.c, b.c))) GROUP BY 1)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM x JOIN k USING (n, c) LEFT JOIN l USING (class_id)"""))
def char_jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIM-6: the prefilter by length and letters, of all titles: classes that it can't tell apart, and their links."""
    return M.may_match_classes(S.titles_doc(spark, sf_dir), 0.7)
