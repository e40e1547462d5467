"""Feeds and ranked lists as text: parsed with Spark's own JSON and XML functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIST = "status string, items array<struct<title:string,url:string,mobileUrl:string>>"
JSON_FEED = "version string, title string, items array<struct<id:string,url:string,title:string,summary:string,content_text:string,date_published:string,authors:array<struct<name:string>>>>"
RSS_ITEM = "title STRING, link STRING, guid STRING, description STRING, pubDate STRING"


def ranked_list(raw: DataFrame) -> DataFrame:
    """SRC-1, SRC-2: source_id, body (JSON) to source_id, title, ranks, url: positions of each trimmed title from 1."""
    rows = raw.select("source_id", F.from_json("body", LIST).alias("b")).where(F.col("b.status").isin("success", "cache"))
    items = rows.select("source_id", F.posexplode("b.items").alias("pos", "item")).select("source_id", (F.col("pos") + 1).alias("rank"), F.trim("item.title").alias("title"), "item.url")
    return items.where("title <> ''").groupBy("source_id", "title").agg(F.sort_array(F.collect_list("rank")).alias("ranks"), F.min_by("url", "rank").alias("url"))


def json_feed(raw: DataFrame) -> DataFrame:
    """SRC-6, SRC-7: feed_id, body (JSON Feed) to entries; a missing title is taken from the summary, then the url."""
    rows = raw.select("feed_id", F.from_json("body", JSON_FEED).alias("b")).where(F.contains("b.version", F.lit("jsonfeed.org")))
    e = rows.select("feed_id", F.posexplode("b.items").alias("pos", "item")).select("feed_id", "pos", "item.*")
    short = F.concat(F.substring(F.coalesce(F.nullif("summary", F.lit("")), F.col("content_text")), 1, 20), F.lit("..."))
    title = F.coalesce(F.nullif(F.trim("title"), F.lit("")), short, F.nullif("url", F.lit("")))
    return e.select("feed_id", "pos", title.alias("title"), "url", F.coalesce(F.nullif("id", F.lit("")), F.col("url")).alias("guid"), F.coalesce(F.get(F.col("authors"), 0)["name"], F.lit("")).alias("author")).where("title is not null")


def rss_items(raw: DataFrame) -> DataFrame:
    """SRC-5, SRC-13: feed_id, body (RSS) to items; a body with a document type, or that is no XML, gives none."""
    safe = raw.where(~F.contains(F.upper("body"), F.lit("<!DOCTYPE")))
    items = safe.select("feed_id", F.from_xml("body", f"channel STRUCT<item: ARRAY<STRUCT<{RSS_ITEM.replace(' STRING', ': STRING')}>>>", {"mode": "PERMISSIVE"}).alias("b"))
    return items.select("feed_id", F.posexplode("b.channel.item").alias("pos", "item")).select("feed_id", "pos", "item.*")
