"""Adapters: the analytics' tables, derived from the star schema, events and documents of a folder.

Each has a twin in SQL (SQL[name]) that the oracle queries put before their own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Queries that depend on the time take this instead of the clock.
AS_OF = "2024-01-30 23:59:59"
AS_OF_DATE = "2024-01-30"

SQL = {
    "obs": """SELECT event_type AS source_id, user_id % 20 AS item_key, date_trunc('hour', ts) AS crawl_ts, CAST(ts AS DATE) AS crawl_date,
        strftime(date_trunc('hour', ts), '%H:%M') AS crawl_time, MIN(1 + CAST(json_extract(props, '$.k') AS INT) % 30) AS rank,
        MIN(event_id) AS event_id, MIN(user_id) AS doc_id FROM events GROUP BY ALL""",
    "batches": "SELECT DISTINCT source_id, crawl_date, crawl_ts FROM obs",
    "obs_titles": """SELECT o.*, CASE WHEN o.event_id % 7 = 0 THEN 'https://list.example/' || source_id || '/' || item_key ELSE substr(trim(split_part(d.text, chr(10), 1)), 1, 80) END AS title
        FROM obs o JOIN documents d USING (doc_id)""",
    "titles": """SELECT date, source_id, title, COUNT(*) AS n, MIN(ts) AS first_ts, MAX(ts) AS last_ts, MIN(event_id) AS pos, list_sort(list(DISTINCT rank)) AS ranks FROM (
        SELECT CAST(e.ts AS DATE) AS date, e.event_type AS source_id, substr(trim(split_part(d.text, chr(10), 1)), 1, 80) AS title, e.ts, e.event_id, 1 + CAST(json_extract(e.props, '$.k') AS INT) % 30 AS rank
        FROM events e JOIN documents d ON e.user_id = d.doc_id) WHERE title <> '' GROUP BY 1, 2, 3""",
    "titles_doc": "SELECT doc_id, source AS source_id, lang, substr(trim(split_part(text, chr(10), 1)), 1, 80) AS title FROM documents",
    "rss": """SELECT d.doc_id AS item_id, d.source AS feed_id, substr(trim(split_part(d.text, chr(10), 1)), 1, 80) AS title, d.text AS summary, p.url, e.ts AS published_at,
        CASE WHEN d.doc_id % 2 = 1 THEN '' ELSE 'g' || d.doc_id END AS guid
        FROM documents d JOIN events e ON d.doc_id = e.event_id JOIN pages p ON p.page_id = d.doc_id % (SELECT COUNT(*) FROM pages)""",
    "articles": """SELECT o_orderkey AS article_key, o_custkey % 50 AS group_no, CASE o_orderpriority WHEN '1-URGENT' THEN 'alpha' WHEN '2-HIGH' THEN 'alpha' ELSE 'beta' END AS publisher,
        CASE o_orderstatus WHEN 'F' THEN 'notified' WHEN 'O' THEN 'shared' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'doc_created' ELSE 'fetched' END END AS status,
        CAST(epoch(o_orderdate) AS BIGINT) AS discovered_at, o_orderkey % 9 AS failures, o_totalprice AS price,
        CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN '' ELSE 'd' || (o_orderkey % 12000) END AS document_id,
        CAST(epoch(o_orderdate) AS BIGINT) + (o_orderkey % 9) * 3600 AS next_at FROM orders""",
    "tag_results": """SELECT doc_id AS item_id, tag_id, tag, score, doc_id % 3 AS version FROM (
        SELECT doc_id, 1 AS tag_id, 'quality' AS tag, CAST(quality AS DOUBLE) AS score FROM labels UNION ALL SELECT doc_id, 2, 'toxic', CAST(toxic AS DOUBLE) FROM labels)""",
}


def with_(*names: str, body: str) -> str:
    """A query with the adapters it needs put before it, in the order of SQL."""
    need = set(names)
    if "batches" in need or "obs_titles" in need:
        need.add("obs")
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in SQL.items() if k in need) + ("\n" if not body.lstrip().startswith(",") else "") + body


#: Tables of long texts, and rows of them in an Arrow batch.
LONG, BATCH_ROWS = ("documents", "pages"), 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table; timestamps without a zone are read as UTC. Python stages behind long texts get few of them at a time."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if name in LONG and int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"})


def _rank():
    return (1 + F.get_json_object("props", "$.k").cast("int") % 30).alias("rank")


def first_line(text):
    return F.substring(F.trim(F.substring_index(text, "\n", 1)), 1, 80)


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observation log: one row for each source, item and hourly batch."""
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("source_id"), (F.col("user_id") % 20).alias("item_key"), F.date_trunc("hour", "ts").alias("crawl_ts"), F.to_date("ts").alias("crawl_date"), _rank(), "event_id", "user_id")
    out = e.groupBy("source_id", "item_key", "crawl_ts", "crawl_date").agg(F.min("rank").alias("rank"), F.min("event_id").alias("event_id"), F.min("user_id").alias("doc_id"))
    return out.withColumn("crawl_time", F.date_format("crawl_ts", "HH:mm"))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Successful runs of each source: the hours in which it was seen."""
    return obs(spark, sf_dir).select("source_id", "crawl_date", "crawl_ts").distinct()


def obs_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with a title; every seventh has a link in the title's place."""
    d = table(spark, sf_dir, "documents").select("doc_id", first_line("text").alias("line"))
    link = F.concat(F.lit("https://list.example/"), "source_id", F.lit("/"), F.col("item_key").cast("string"))
    return obs(spark, sf_dir).join(d, "doc_id").withColumn("title", F.when(F.col("event_id") % 7 == 0, link).otherwise(F.col("line"))).drop("line")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each day, source and title, with its ranks."""
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("source_id"), F.to_date("ts").alias("date"), "ts", "event_id", F.col("user_id").alias("doc_id"), _rank())
    d = table(spark, sf_dir, "documents").select("doc_id", first_line("text").alias("title"))
    t = e.join(d, "doc_id").where("title <> ''")
    return t.groupBy("date", "source_id", "title").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.min("event_id").alias("pos"), F.sort_array(F.collect_set("rank")).alias("ranks"))


def titles_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("source_id"), "lang", first_line("text").alias("title"))


def rss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed entries; urls repeat. What is narrow is joined first, so that texts are shuffled once."""
    d, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    n = F.broadcast(pages.agg(F.count("*").alias("n_pages")))  # one row
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), F.col("ts").alias("published_at")).join(d.select("doc_id"), "doc_id", "left_semi")
    e = e.crossJoin(n).withColumn("page_id", F.col("doc_id") % F.col("n_pages")).join(pages.select("page_id", "url"), "page_id")
    rows = d.join(e, "doc_id")
    guid = F.when(F.col("doc_id") % 2 == 1, F.lit("")).otherwise(F.concat(F.lit("g"), F.col("doc_id").cast("string")))
    return rows.select(F.col("doc_id").alias("item_id"), F.col("source").alias("feed_id"), first_line("text").alias("title"), F.col("text").alias("summary"), "url", "published_at", guid.alias("guid"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the delivery queue."""
    o = table(spark, sf_dir, "orders")
    key, at = F.col("o_orderkey"), F.unix_timestamp("o_orderdate")
    status = F.when(F.col("o_orderstatus") == "F", "notified").when(F.col("o_orderstatus") == "O", "shared").when(key % 2 == 0, "doc_created").otherwise("fetched")
    document = F.when((F.col("o_orderstatus") == "F") & (key % 3 == 0), "").otherwise(F.concat(F.lit("d"), (key % 12000).cast("string")))
    return o.select(
        key.alias("article_key"), (F.col("o_custkey") % 50).alias("group_no"), F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "alpha").otherwise("beta").alias("publisher"),
        status.alias("status"), at.alias("discovered_at"), (key % 9).alias("failures"), F.col("o_totalprice").alias("price"), document.alias("document_id"), (at + (key % 9) * 3600).alias("next_at"),
    )


def tag_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of two tags for labelled documents."""
    cells = F.array(*[F.struct(F.lit(i).alias("tag_id"), F.lit(t).alias("tag"), F.col(t).cast("double").alias("score")) for i, t in ((1, "quality"), (2, "toxic"))])
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("item_id"), F.inline(cells), (F.col("doc_id") % 3).alias("version"))
