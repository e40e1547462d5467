"""Queries of the observation log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import history as H
from tidemark.plans.catalog import query
from tidemark.sources import tables as S
from tidemark.sources.tables import with_

_KEY = "CAST(crawl_date AS VARCHAR) AS crawl_date, source_id, item_key"


def _out(df: DataFrame, *cols) -> DataFrame:
    return df.select(F.col("crawl_date").cast("string").alias("crawl_date"), "source_id", "item_key", *cols)


def _ts(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm").alias(name)


_TS = "strftime({0}, '%Y-%m-%d %H:%M') AS {0}".format


def _ordered_distinct(values: str) -> str:
    return f"array_to_string(list_filter({values}, lambda x, i: list_position({values}, x) = i), ',')"


@query(with_("obs", body=f"SELECT {_KEY}, COUNT(*) AS crawl_count, MIN(crawl_time) AS first_time, MAX(crawl_time) AS last_time, arg_max(rank, crawl_ts) AS rank, {_ordered_distinct('list(rank ORDER BY crawl_ts)')} AS ranks FROM obs GROUP BY obs.crawl_date, source_id, item_key"))
def item_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-1, ST-2: the fold of each item's observations of a day."""
    return _out(H.fold(S.obs(spark, sf_dir)), "crawl_count", "first_time", "last_time", "rank", H.joined(F.col("ranks")).alias("ranks"))


_TOMB = """, nexts AS (SELECT *, lead(crawl_ts) OVER (PARTITION BY source_id, crawl_date ORDER BY crawl_ts) AS next_ts FROM batches),
tomb AS (SELECT o.crawl_date, o.source_id, o.item_key, n.next_ts AS crawl_ts, strftime(n.next_ts, '%H:%M') AS crawl_time, 0 AS rank FROM obs o JOIN nexts n USING (source_id, crawl_date, crawl_ts)
  WHERE n.next_ts IS NOT NULL AND NOT EXISTS (SELECT 1 FROM obs x WHERE x.source_id = o.source_id AND x.item_key = o.item_key AND x.crawl_date = o.crawl_date AND x.crawl_ts = n.next_ts)),
line AS (SELECT * FROM (SELECT *, MAX(CASE WHEN rank > 0 THEN crawl_ts END) OVER (PARTITION BY crawl_date, source_id, item_key) AS last_ts FROM
  (SELECT crawl_date, source_id, item_key, crawl_ts, crawl_time, rank FROM obs UNION ALL SELECT crawl_date, source_id, item_key, crawl_ts, crawl_time, rank FROM tomb)) WHERE NOT (rank = 0 AND crawl_ts > last_ts))
"""


@query(with_("obs", "batches", body=_TOMB + f"SELECT {_KEY}, {_TS('crawl_ts')} FROM tomb"))
def off_list_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-5, JN-10, JN-21: items that the source's next batch lacks."""
    o = S.obs(spark, sf_dir)
    return _out(H.tombstones(o, S.batches(spark, sf_dir)), _ts("crawl_ts"))


@query(with_("obs", "batches", body=_TOMB + f"SELECT {_KEY}, string_agg(crawl_time || '=' || CASE WHEN rank = 0 THEN '-' ELSE rank::VARCHAR END, ' ' ORDER BY crawl_ts) AS timeline FROM line GROUP BY line.crawl_date, source_id, item_key"))
def rank_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-2, FL-10: ranks by time, with the gaps that the item came back from."""
    line = H.timeline(S.obs(spark, sf_dir), S.batches(spark, sf_dir))
    point = lambda p: F.concat(p["crawl_time"], F.lit("="), F.when(p["rank"] == 0, "-").otherwise(p["rank"].cast("string")))
    return _out(line.groupBy(*H.ITEM).agg(H.ordered("crawl_time", "rank").alias("p")), F.array_join(F.transform("p", point), " ").alias("timeline"))


@query(with_("obs", body=f"SELECT {_KEY}, array_to_string(list(rank ORDER BY crawl_ts), ',') AS ranks, COUNT(*) AS n FROM obs GROUP BY obs.crawl_date, source_id, item_key"))
def item_ranks_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-3: all ranks of an item in order."""
    out = S.obs(spark, sf_dir).groupBy(*H.ITEM).agg(H.ordered("rank").alias("p"))
    return _out(out, H.joined(F.transform("p", lambda p: p["rank"])).alias("ranks"), F.size("p").cast("long").alias("n"))


@query(with_("obs", "batches", body=_TOMB + ", two AS (SELECT *, row_number() OVER (PARTITION BY crawl_date, source_id, item_key ORDER BY crawl_ts DESC) AS k FROM line WHERE rank > 0) " + f"SELECT {_KEY}, CASE WHEN MAX(CASE WHEN k = 2 THEN rank END) IS NULL THEN '' WHEN MAX(CASE WHEN k = 1 THEN rank END) < MAX(CASE WHEN k = 2 THEN rank END) THEN 'up' WHEN MAX(CASE WHEN k = 1 THEN rank END) > MAX(CASE WHEN k = 2 THEN rank END) THEN 'down' ELSE 'same' END AS trend FROM two WHERE k <= 2 GROUP BY two.crawl_date, source_id, item_key"))
def rank_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-3: the last two ranks of an item."""
    out = S.obs(spark, sf_dir).groupBy(*H.ITEM).agg(H.ordered("rank").alias("p"))
    last, before = F.try_element_at("p", F.lit(-1))["rank"], F.try_element_at("p", F.lit(-2))["rank"]
    return _out(out, F.when(before.isNull(), "").when(last < before, "up").when(last > before, "down").otherwise("same").alias("trend"))


_GUARD = """, guarded AS (SELECT * REPLACE (coalesce(last_value(CASE WHEN NOT regexp_matches(title, '^(https?:)?//') THEN title END IGNORE NULLS) OVER (PARTITION BY crawl_date, source_id, item_key ORDER BY crawl_ts), title) AS title) FROM obs_titles),
lagged AS (SELECT *, lag(title) OVER (PARTITION BY crawl_date, source_id, item_key ORDER BY crawl_ts) AS old_title FROM guarded) """


@query(with_("obs", "obs_titles", body=_GUARD + f"SELECT {_KEY}, {_TS('crawl_ts')}, old_title, title AS new_title FROM lagged WHERE old_title IS NOT NULL AND old_title <> title"))
def title_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-3, TX-22: consecutive titles that differ, after the guard against links."""
    return _out(H.title_changes(S.obs_titles(spark, sf_dir)), _ts("crawl_ts"), "old_title", "new_title")


@query(with_("obs", "obs_titles", body=_GUARD + f"SELECT {_KEY}, arg_max(title, crawl_ts) AS title, MIN(crawl_time) AS first_time, MAX(crawl_time) AS last_time, COUNT(*) AS crawl_count, arg_max(rank, crawl_ts) AS rank FROM guarded GROUP BY guarded.crawl_date, source_id, item_key"))
def upsert_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-2, ST-4, SM-2: the row that upserts of all batches would leave."""
    g = H.guarded_titles(S.obs_titles(spark, sf_dir)).groupBy(*H.ITEM)
    return _out(g.agg(F.max_by("title", "crawl_ts").alias("title"), F.min("crawl_time").alias("first_time"), F.max("crawl_time").alias("last_time"), F.count("*").alias("crawl_count"), F.max_by("rank", "crawl_ts").alias("rank")), "title", "first_time", "last_time", "crawl_count", "rank")


@query(with_("titles", body="SELECT CAST(date AS VARCHAR) AS date, source_id, title, n FROM titles WHERE date_trunc('hour', last_ts) = (SELECT max(date_trunc('hour', last_ts)) FROM titles)"))
def latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL-7: rows of the last batch over all sources."""
    t = S.titles(spark, sf_dir).withColumn("last_hour", F.date_trunc("hour", "last_ts"))
    return H.latest(t, "last_hour").select(F.col("date").cast("string").alias("date"), "source_id", "title", "n")


@query(with_("titles", body=""", h AS (SELECT source_id, title, date_trunc('hour', min(first_ts)) AS f, date_trunc('hour', max(last_ts)) AS l FROM titles WHERE date = DATE '2024-01-01' GROUP BY 1, 2), m AS (SELECT max(l) AS l FROM h)
SELECT source_id, title FROM h, m WHERE h.l = m.l AND NOT EXISTS (SELECT 1 FROM h o WHERE o.source_id = h.source_id AND o.title = h.title AND o.f < m.l)"""))
def new_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-7, SM-4: titles of the first day's last batch that their source never had before."""
    t = S.titles(spark, sf_dir).where("date = date '2024-01-01'").groupBy("source_id", "title").agg(F.date_trunc("hour", F.min("first_ts")).alias("f"), F.date_trunc("hour", F.max("last_ts")).alias("l"))
    return H.new_since(t, ["source_id", "title"], "f", "l").select("source_id", "title")


@query(with_("obs", "batches", body=f"SELECT source_id, {_TS('crawl_ts')}, strftime(lag(crawl_ts) OVER (PARTITION BY source_id, crawl_date ORDER BY crawl_ts), '%Y-%m-%d %H:%M') AS previous FROM batches"))
def prev_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-4, JN-21: the batch before each."""
    w = Window.partitionBy("source_id", "crawl_date").orderBy("crawl_ts")
    return S.batches(spark, sf_dir).select("source_id", _ts("crawl_ts"), F.date_format(F.lag("crawl_ts").over(w), "yyyy-MM-dd HH:mm").alias("previous"))


@query(with_("obs", "batches", body="SELECT CAST(crawl_date AS VARCHAR) AS crawl_date, COUNT(DISTINCT crawl_ts) AS n_batches, COUNT(DISTINCT crawl_ts) <= 1 AS first_crawl FROM batches GROUP BY batches.crawl_date"))
def first_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-8: whether a day has had one batch at most."""
    n = S.batches(spark, sf_dir).groupBy("crawl_date").agg(F.count_distinct("crawl_ts").alias("n_batches"))
    return n.select(F.col("crawl_date").cast("string").alias("crawl_date"), "n_batches", (F.col("n_batches") <= 1).alias("first_crawl"))


@query(with_("obs", "batches", "obs_titles", body=_TOMB.replace(", nexts", ", nexts", 1) + _GUARD + """, counted AS (SELECT crawl_ts, count(*) AS seen, count(*) FILTER (first) AS n_new, count(*) FILTER (NOT first) AS n_updated FROM
(SELECT crawl_ts, row_number() OVER (PARTITION BY crawl_date, source_id, item_key ORDER BY crawl_ts) = 1 AS first FROM obs) GROUP BY 1)
SELECT strftime(c.crawl_ts, '%Y-%m-%d %H:%M') AS crawl_ts, n_new, n_updated, coalesce(n_changed, 0) AS n_changed, coalesce(n_off, 0) AS n_off FROM counted c
LEFT JOIN (SELECT crawl_ts, count(*) AS n_changed FROM lagged WHERE old_title IS NOT NULL AND old_title <> title GROUP BY 1) x ON x.crawl_ts = c.crawl_ts
LEFT JOIN (SELECT crawl_ts, count(*) AS n_off FROM tomb GROUP BY 1) y ON y.crawl_ts = c.crawl_ts"""))
def batch_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-27: what each batch added, updated, renamed and dropped."""
    o = S.obs(spark, sf_dir)
    first = F.row_number().over(Window.partitionBy(*H.ITEM).orderBy("crawl_ts")) == 1
    kinds = o.select("crawl_ts", F.when(first, "new").otherwise("updated").alias("kind"))
    kinds = kinds.union(H.title_changes(S.obs_titles(spark, sf_dir)).select("crawl_ts", F.lit("changed"))).union(H.tombstones(o, S.batches(spark, sf_dir)).select("crawl_ts", F.lit("off")))
    return kinds.groupBy("crawl_ts").agg(*[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("new", "updated", "changed", "off")]).withColumn("crawl_ts", F.date_format("crawl_ts", "yyyy-MM-dd HH:mm"))


@query(with_("obs", body="SELECT source_id, item_key, array_to_string(list_sort(list(DISTINCT rank)), ',') AS ranks, min(crawl_time) AS first_time, max(crawl_time) AS last_time, count(*) AS n FROM obs GROUP BY 1, 2"))
def batch_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-21, SO-3: batches merged by item: the union of ranks, the ends of time, the count."""
    return S.obs(spark, sf_dir).groupBy("source_id", "item_key").agg(H.joined(F.sort_array(F.collect_set("rank"))).alias("ranks"), F.min("crawl_time").alias("first_time"), F.max("crawl_time").alias("last_time"), F.count("*").alias("n"))


@query(with_("obs", body=f"SELECT {_TS('crawl_ts')}, count(*) AS total_items, count(DISTINCT source_id) AS n_sources FROM obs GROUP BY obs.crawl_ts"))
def crawl_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-6: one row for each batch."""
    return S.obs(spark, sf_dir).groupBy("crawl_ts").agg(F.count("*").alias("total_items"), F.count_distinct("source_id").alias("n_sources")).withColumn("crawl_ts", F.date_format("crawl_ts", "yyyy-MM-dd HH:mm"))


@query(with_("obs", "batches", body=f""", slots AS (SELECT DISTINCT crawl_ts FROM batches), src AS (SELECT DISTINCT source_id FROM batches)
SELECT src.source_id, count(*) AS n_failed FROM slots CROSS JOIN src LEFT JOIN batches b ON b.source_id = src.source_id AND b.crawl_ts = slots.crawl_ts WHERE b.source_id IS NULL GROUP BY 1"""))
def failed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-4: sources that missed batches in which others ran."""
    b = S.batches(spark, sf_dir)
    n = b.select("crawl_ts").distinct().agg(F.count("*").alias("slots"))
    ran = b.groupBy("source_id").agg(F.count("*").alias("ran"))
    return ran.crossJoin(F.broadcast(n)).where("slots > ran").select("source_id", (F.col("slots") - F.col("ran")).alias("n_failed"))


@query(with_("obs", body=", platforms AS (SELECT DISTINCT source_id AS id, CASE WHEN source_id = 'click' THEN '' ELSE upper(source_id) END AS name FROM obs) SELECT source_id, coalesce(nullif(name, ''), source_id) AS source_name, count(*) AS n, min(rank) AS best_rank FROM obs LEFT JOIN platforms ON id = source_id GROUP BY 1, 2"))
def platform_dim_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-1, JN-2, PJ-2, FL-1: items with their platform's name, or its id."""
    o = S.obs(spark, sf_dir)
    platforms = o.select(F.col("source_id").alias("id")).distinct().withColumn("name", F.when(F.col("id") == "click", "").otherwise(F.upper("id")))
    per = o.groupBy("source_id").agg(F.count("*").alias("n"), F.min("rank").alias("best_rank"))
    return per.join(platforms, F.col("id") == F.col("source_id"), "left").select("source_id", F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("source_id")).alias("source_name"), "n", "best_rank")


@query(with_("obs", "batches", body=f""", numbered AS (SELECT *, row_number() OVER (PARTITION BY source_id, crawl_date ORDER BY crawl_ts) AS no FROM batches),
runs AS (SELECT o.*, no - row_number() OVER (PARTITION BY o.crawl_date, o.source_id, item_key ORDER BY no) AS run FROM obs o JOIN numbered USING (source_id, crawl_date, crawl_ts))
SELECT {_KEY}, min(crawl_time) AS first_time, max(crawl_time) AS last_time, count(*) AS n FROM runs GROUP BY runs.crawl_date, source_id, item_key, run"""))
def appearance_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SM-7, DT-6: stretches in which an item was listed."""
    return _out(H.intervals(S.obs(spark, sf_dir), S.batches(spark, sf_dir)), "first_time", "last_time", "n")


@query(with_("obs", body="SELECT source_id AS id, upper(source_id) AS name, strftime(max(crawl_ts), '%Y-%m-%d %H:%M') AS updated_at FROM obs GROUP BY 1, 2"))
def dimension_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-1: the latest row of each platform."""
    return S.obs(spark, sf_dir).groupBy(F.col("source_id").alias("id")).agg(F.max_by(F.upper("source_id"), "crawl_ts").alias("name"), F.date_format(F.max("crawl_ts"), "yyyy-MM-dd HH:mm").alias("updated_at"))


@query(with_("obs", "batches", body="SELECT DISTINCT CAST(crawl_date AS VARCHAR) AS execution_date, 'p' || (hour(crawl_ts) // 6) AS period_key, 'push' AS action FROM batches WHERE NOT (crawl_date <= DATE '2024-01-03')"))
def execution_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-9, SM-9: periods to be run once, without those that the ledger has."""
    runs = S.batches(spark, sf_dir).select(F.col("crawl_date").cast("string").alias("execution_date"), F.concat(F.lit("p"), F.floor(F.hour("crawl_ts") / 6).cast("string")).alias("period_key"), F.lit("push").alias("action")).distinct()
    return runs.join(runs.where("execution_date <= '2024-01-03'"), ["execution_date", "period_key", "action"], "left_anti")


@query(with_("obs", body="SELECT DISTINCT CAST(crawl_date AS VARCHAR) AS crawl_date FROM obs"))
def available_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-11: the days that there are."""
    return S.obs(spark, sf_dir).select(F.col("crawl_date").cast("string").alias("crawl_date")).distinct()


@query(with_("obs", body=f"SELECT CAST(crawl_date AS VARCHAR) AS crawl_date, count(*) AS n FROM obs WHERE crawl_date < DATE '{S.AS_OF_DATE}' - 7 GROUP BY obs.crawl_date"))
def retention_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-9: partitions older than seven days, to be dropped."""
    old = S.obs(spark, sf_dir).where(F.col("crawl_date") < F.date_sub(F.lit(S.AS_OF_DATE).cast("date"), 7))
    return old.groupBy(F.col("crawl_date").cast("string").alias("crawl_date")).agg(F.count("*").alias("n"))


@query(with_("obs", body=f""", d AS (SELECT DISTINCT crawl_date FROM obs), wanted AS (SELECT CAST(unnest(generate_series(DATE '{S.AS_OF_DATE}' - 13, DATE '{S.AS_OF_DATE}', INTERVAL 1 DAY)) AS DATE) AS crawl_date)
SELECT CAST(crawl_date AS VARCHAR) AS crawl_date FROM wanted WHERE crawl_date IN (SELECT crawl_date FROM d) AND crawl_date NOT IN (SELECT crawl_date FROM d WHERE day(crawl_date) % 2 = 0)"""))
def remote_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-10: of the last 14 days those that the remote has (all) and the local side lacks (odd days)."""
    remote = S.obs(spark, sf_dir).select("crawl_date").distinct()
    local = remote.where(F.dayofmonth("crawl_date") % 2 == 0)
    end = F.lit(S.AS_OF_DATE).cast("date")
    wanted = spark.range(1).select(F.explode(F.sequence(F.date_sub(end, 13), end)).alias("crawl_date"))
    return wanted.join(remote, "crawl_date", "left_semi").join(local, "crawl_date", "left_anti").select(F.col("crawl_date").cast("string").alias("crawl_date"))


@query(with_("obs", body=""", d AS (SELECT DISTINCT crawl_date FROM obs), l AS (SELECT * FROM d WHERE day(crawl_date) % 2 = 0), r AS (SELECT * FROM d WHERE day(crawl_date) % 3 = 0)
SELECT CAST(coalesce(l.crawl_date, r.crawl_date) AS VARCHAR) AS crawl_date, CASE WHEN r.crawl_date IS NULL THEN 'local' WHEN l.crawl_date IS NULL THEN 'remote' ELSE 'both' END AS side FROM l FULL JOIN r ON l.crawl_date = r.crawl_date"""))
def date_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-30, SO-5: days only here, only there, or on both sides."""
    d = S.obs(spark, sf_dir).select("crawl_date").distinct()
    here, there = d.where(F.dayofmonth("crawl_date") % 2 == 0).withColumn("here", F.lit(True)), d.where(F.dayofmonth("crawl_date") % 3 == 0).withColumn("there", F.lit(True))
    side = F.when(F.col("there").isNull(), "local").when(F.col("here").isNull(), "remote").otherwise("both")
    return here.join(there, "crawl_date", "full").select(F.col("crawl_date").cast("string").alias("crawl_date"), side.alias("side"))
