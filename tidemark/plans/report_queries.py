"""Queries of keyword reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scores
from tidemark.functions.scores import WEIGHT_SQL
from tidemark.operators import history as H
from tidemark.operators import report as R
from tidemark.plans import rules as K
from tidemark.plans.catalog import query
from tidemark.sources import tables as S
from tidemark.sources.tables import with_

_DAY = S.AS_OF_DATE
_GROUPS = "(VALUES " + ", ".join(f"({i}, '{g.name}', {g.most})" for i, g in enumerate(K.RULES.groups)) + ") AS g(position, word, most)"
_ORDER = "weight DESC, coalesce(list_min(ranks), 999), n DESC, title, source_id, date"


def _matched(rows: str) -> str:
    return f""", base AS ({rows}), found AS (SELECT * FROM (SELECT *, {K.sql(K.RULES)} AS position, round({WEIGHT_SQL}, 6) AS weight FROM base) WHERE position IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY position ORDER BY {_ORDER}) AS place, count(*) OVER (PARTITION BY position) AS count FROM found) """


_REPORT = f"""SELECT word, place::INT AS place, title, source_id, weight, count, round(count * 100 / (SELECT count(*) FROM base), 2) AS percentage FROM ranked JOIN {_GROUPS} USING (position) WHERE most = 0 OR place <= most"""


def _report(titles: DataFrame) -> DataFrame:
    return R.grouped(titles, K.RULES).select("word", "place", "title", "source_id", "weight", "count", "percentage")


def _day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.titles(spark, sf_dir).where(F.col("date") == F.lit(_DAY).cast("date"))


_DAILY = f"SELECT * FROM titles WHERE date = DATE '{_DAY}'"
_CURRENT = f"SELECT * FROM titles WHERE date = DATE '{_DAY}' AND date_trunc('hour', last_ts) = (SELECT max(date_trunc('hour', last_ts)) FROM titles WHERE date = DATE '{_DAY}')"
_SECOND = "2024-01-02"  # later days of the test data bring no title that is new
_NEW = f"SELECT * FROM titles WHERE date = DATE '{_SECOND}' AND (source_id, title) NOT IN (SELECT (source_id, title) FROM titles WHERE date < DATE '{_SECOND}')"


@query(with_("titles", body=_matched(_DAILY) + _REPORT))
def keyword_report_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP-1, AG-4, TD-10, JN-14, WN-2, OR-1: a day's titles by rule group, in order, cut to the group's limit."""
    return _report(_day(spark, sf_dir))


@query(with_("titles", body=_matched(_CURRENT) + _REPORT))
def keyword_report_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP-2: the same of the last batch."""
    day = _day(spark, sf_dir).withColumn("last_hour", F.date_trunc("hour", "last_ts"))
    return _report(H.latest(day, "last_hour").drop("last_hour"))


def _fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = S.titles(spark, sf_dir)
    day = F.lit(_SECOND).cast("date")
    return t.where(F.col("date") == day).join(t.where(F.col("date") < day).select("source_id", "title").distinct(), ["source_id", "title"], "left_anti")


@query(with_("titles", body=_matched(_NEW) + _REPORT))
def keyword_report_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP-3: the same of titles that are new."""
    return _report(_fresh(spark, sf_dir))


@query(with_("titles", body=_matched("SELECT * FROM titles") + f"SELECT g.position, word, coalesce(c, 0) AS count, round(coalesce(c, 0) * 100 / (SELECT count(*) FROM base), 2) AS percentage FROM {_GROUPS} LEFT JOIN (SELECT position, count(*) AS c FROM found GROUP BY 1) f ON f.position = g.position"))
def keyword_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-4, OR-2: counts of all groups over all days."""
    return R.group_counts(S.titles(spark, sf_dir), K.RULES)


@query(with_("titles", body=_matched("SELECT * FROM titles") + f", one AS (SELECT source_id, title, min(position) AS position FROM found GROUP BY 1, 2) SELECT source_id, word, count(*) AS n FROM one JOIN {_GROUPS} USING (position) GROUP BY 1, 2"))
def platform_regroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-6, OR-3, WN-9: groups by platform; a title counts in its first group."""
    found = R.matched(S.titles(spark, sf_dir), K.RULES).groupBy("source_id", "title").agg(F.min("position").alias("position"))
    return found.groupBy("source_id", "position").agg(F.count("*").alias("n")).join(F.broadcast(R.groups_table(found, K.RULES)), "position").select("source_id", "word", "n")


@query(with_("titles_doc", body=f" SELECT doc_id, coalesce(CAST({K.sql(K.RULES)} AS INT), -1) AS position FROM titles_doc"))
def rule_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX-2, TX-3, FL-11: the group that takes each title."""
    return S.titles_doc(spark, sf_dir).select("doc_id", F.coalesce(K.group_of(K.RULES, F.col("title"), position=True), F.lit(-1)).alias("position"))


@query(with_("titles", body=f" SELECT CAST(date AS VARCHAR) AS date, source_id, title, round({WEIGHT_SQL}, 6) AS weight FROM titles"))
def news_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TD-10."""
    return S.titles(spark, sf_dir).select(F.col("date").cast("string").alias("date"), "source_id", "title", F.round(scores.weight(F.col("ranks"), F.col("n")), 6).alias("weight"))


@query(with_("titles", body=""" SELECT CAST(date AS VARCHAR) AS date, source_id, title, CASE WHEN len(ranks) = 0 THEN '' ELSE CASE WHEN list_min(ranks) <= 5 THEN '**' ELSE '' END || CASE WHEN list_min(ranks) = list_max(ranks) THEN '[' || list_min(ranks) || ']' ELSE '[' || list_min(ranks) || ' - ' || list_max(ranks) || ']' END || CASE WHEN list_min(ranks) <= 5 THEN '**' ELSE '' END END AS ranks,
CASE WHEN n >= 10 THEN 'hot' WHEN n >= 5 THEN 'warm' ELSE '' END AS hotness, CASE WHEN list_min(ranks) <= 3 THEN 'top' WHEN list_min(ranks) <= 5 THEN 'high' ELSE '' END AS rank_class, '[' || strftime(first_ts, '%H:%M') || ' ~ ' || strftime(last_ts, '%H:%M') || ']' AS span FROM titles"""))
def rank_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX-16, RP-11, DT-6: how ranks, hotness and times are shown."""
    at = lambda c: F.date_format(c, "HH:mm")
    return S.titles(spark, sf_dir).select(
        F.col("date").cast("string").alias("date"), "source_id", "title", scores.rank_text(F.col("ranks")).alias("ranks"), scores.hotness(F.col("n")).alias("hotness"), scores.rank_class(F.array_min("ranks")).alias("rank_class"),
        F.concat(F.lit("["), at("first_ts"), F.lit(" ~ "), at("last_ts"), F.lit("]")).alias("span"),
    )


@query(with_("titles", body=f" SELECT source_id, row_number() OVER (PARTITION BY source_id ORDER BY list_min(ranks), title)::INT AS line_no, list_min(ranks) || '. ' || title || ' [x' || n || ']' AS line FROM titles WHERE date = DATE '{_DAY}'"))
def snapshot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4: the text snapshot's lines, by source and rank."""
    w = Window.partitionBy("source_id").orderBy(F.array_min("ranks"), "title")
    line = F.concat(F.array_min("ranks").cast("string"), F.lit(". "), "title", F.lit(" [x"), F.col("n").cast("string"), F.lit("]"))
    return _day(spark, sf_dir).select("source_id", F.row_number().over(w).alias("line_no"), line.alias("line"))


@query(with_("titles", body=_matched(_DAILY) + """, picked AS (SELECT source_id, title, position, place, row_number() OVER (ORDER BY position, place) AS k FROM ranked)
SELECT source_id, title, position, place::INT AS place, k::INT AS k FROM picked WHERE k <= 25"""))
def quota_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-12: the first 25 items in group order."""
    found = R.matched(_day(spark, sf_dir), K.RULES).withColumn("place", F.row_number().over(Window.partitionBy("position").orderBy(*R.order())))
    top = found.orderBy("position", "place").limit(25)
    return top.select("source_id", "title", "position", "place", F.row_number().over(Window.orderBy("position", "place")).alias("k"))


@query(with_("titles", body=f", n AS ({_NEW}) SELECT source_id, title, ranks[1] AS best_rank FROM n WHERE title IN (SELECT title FROM (SELECT *, {K.sql(K.RULES)} AS position FROM titles WHERE date = DATE '{_SECOND}') WHERE position IS NOT NULL)"))
def new_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-11, RP-6: new titles that the report's filter lets through, by title alone."""
    kept = R.matched(S.titles(spark, sf_dir).where(F.col("date") == F.lit(_SECOND).cast("date")), K.RULES).select("title").distinct()
    return _fresh(spark, sf_dir).join(kept, "title", "left_semi").select("source_id", "title", F.array_min("ranks").alias("best_rank"))


@query(with_("titles", body=_matched(_DAILY) + f", n AS ({_NEW}) SELECT (SELECT count(*) FROM base) AS total, (SELECT count(*) FROM found) AS matched, (SELECT count(*) FROM n) AS n_new, (SELECT count(DISTINCT source_id) FROM base) AS sources"))
def report_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-28: a report's totals."""
    day = _day(spark, sf_dir)
    head = day.agg(F.count("*").alias("total"), F.count_if(K.group_of(K.RULES, F.col("title"), position=True).isNotNull()).alias("matched"), F.count_distinct("source_id").alias("sources"))
    return head.crossJoin(F.broadcast(_fresh(spark, sf_dir).agg(F.count("*").alias("n_new"))))


@query(with_("obs", "obs_titles", body=f""", last AS (SELECT * FROM obs_titles WHERE crawl_date = DATE '{_DAY}'), l AS (SELECT o.* FROM last o JOIN (SELECT source_id, max(crawl_ts) AS m FROM last GROUP BY 1) x ON x.source_id = o.source_id AND x.m = o.crawl_ts),
r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY rank, item_key) AS k FROM l) SELECT source_id, item_key, title, rank, k::INT AS k FROM r WHERE k <= 5"""))
def standalone_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP-5, OR-16: of each platform its last batch's first five."""
    day = S.obs_titles(spark, sf_dir).where(F.col("crawl_date") == F.lit(_DAY).cast("date"))
    last = day.groupBy("source_id").agg(F.max("crawl_ts").alias("crawl_ts"))
    w = Window.partitionBy("source_id").orderBy(F.when(F.col("rank") > 0, F.col("rank")).otherwise(9999), "item_key")
    return day.join(last, ["source_id", "crawl_ts"]).withColumn("k", F.row_number().over(w)).where("k <= 5").select("source_id", "item_key", "title", "rank", "k")


@query(with_("titles_doc", body=" SELECT doc_id, ((row_number() OVER (PARTITION BY source_id ORDER BY doc_id) - 1) // 20)::INT AS batch, row_number() OVER (PARTITION BY source_id ORDER BY doc_id)::INT AS no, count(*) OVER (PARTITION BY source_id) AS total FROM titles_doc"))
def batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-11, AI-2: batches of 20 in each source, numbered."""
    w = Window.partitionBy("source_id")
    no = F.row_number().over(w.orderBy("doc_id"))
    return S.titles_doc(spark, sf_dir).select("doc_id", F.floor((no - 1) / 20).cast("int").alias("batch"), no.alias("no"), F.count("*").over(w).alias("total"))
