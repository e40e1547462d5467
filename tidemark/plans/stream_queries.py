"""Streams over all the events that there are, against their batch form in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.catalog import query
from tidemark.sources import tables as S
from tidemark.sources.tables import with_
from tidemark.streaming import tombstones as T
from tidemark.streaming import views as V


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.finished(V.daily_counts(V.events(spark, sf_dir)), "complete")


@query("SELECT strftime(d.day, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM (SELECT DISTINCT CAST(ts AS DATE) - i::INT AS day FROM events, range(3) r(i)) d JOIN events e ON CAST(e.ts AS DATE) BETWEEN d.day AND d.day + 2 GROUP BY 1, 2")
def stream_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.finished(V.sliding_counts(V.events(spark, sf_dir)), "complete")


@query("""WITH e AS (SELECT event_type, user_id % 20 AS item_key, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type, user_id % 20 ORDER BY ts)) <= 6 * 3600 * 1000000::BIGINT THEN 0 ELSE 1 END AS first FROM events),
s AS (SELECT *, sum(first) OVER (PARTITION BY event_type, item_key ORDER BY ts) AS no FROM e) SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, event_type, item_key, count(*) AS n FROM s GROUP BY event_type, item_key, no""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.finished(V.sessions(V.events(spark, sf_dir)), "complete")


@query("SELECT event_type, user_id, min(event_id) AS first_event, count(*) AS n FROM events GROUP BY 1, 2")
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.finished(V.first_seen(V.events(spark, sf_dir)), "complete")


@query(with_("obs", "batches", body=""", nexts AS (SELECT *, lead(crawl_ts) OVER (PARTITION BY source_id, crawl_date ORDER BY crawl_ts) AS next_ts FROM batches)
SELECT o.source_id, o.item_key, strftime(n.next_ts, '%Y-%m-%d %H:%M') AS crawl_ts FROM obs o JOIN nexts n USING (source_id, crawl_date, crawl_ts) WHERE n.next_ts + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 DAY FROM events)
AND NOT EXISTS (SELECT 1 FROM obs x WHERE x.source_id = o.source_id AND x.item_key = o.item_key AND x.crawl_ts = n.next_ts)"""))
def stream_off_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SM-3, SM-2, ST-5: items that the source's next batch lacks, once the watermark has passed it, by keyed state and timers."""
    e = V.events(spark, sf_dir).select(F.col("event_type").alias("source_id"), (F.col("user_id") % 20).alias("item_key"), "ts")
    return V.finished(T.off_list(e), "append").select("source_id", "item_key", F.date_format("crawl_ts", "yyyy-MM-dd HH:mm").alias("crawl_ts"))


_LATE = "event_id % 10 = 0"


@query(f"""WITH m AS (SELECT max(ts) FILTER (NOT {_LATE}) - INTERVAL 2 DAY AS first, max(ts) - INTERVAL 2 DAY AS last FROM events), w AS (SELECT *, date_trunc('day', ts) + INTERVAL 1 DAY AS ends, {_LATE} AS late FROM events, m)
SELECT strftime(ends - INTERVAL 1 DAY, '%Y-%m-%d') AS day, event_type, count(*) FILTER (NOT (late AND ends <= first)) AS n, count(*) FILTER (late AND ends <= first) AS n_late FROM w WHERE ends <= last GROUP BY ends, event_type HAVING count(*) FILTER (NOT (late AND ends <= first)) > 0""")
def stream_late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SM-8, SM-5: closed days of a stream in which a tenth of the events comes after all others; those of days closed before are left out, and counted here."""
    e = S.table(spark, sf_dir, "events")
    closed = V.late_counts([e.where(f"not {_LATE}"), e.where(_LATE)])
    all_ = e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("total"))
    return closed.join(all_, ["day", "event_type"]).select("day", "event_type", "n", (F.col("total") - F.col("n")).alias("n_late"))
