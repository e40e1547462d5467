"""Views of the observation log: item histories, tombstones, new and changed titles. No table is updated in place.

An observation has source_id, item_key, crawl_date, crawl_ts, crawl_time and rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ITEM = ["crawl_date", "source_id", "item_key"]


def ordered(*fields: str, key: str = "crawl_ts") -> Column:
    """All rows of a group as an array in the order of `key`."""
    return F.sort_array(F.collect_list(F.struct(key, *fields)))


def distinct_ranks(points: Column) -> Column:
    """Ranks in the order of first appearance, without tombstones (0)."""
    return F.array_distinct(F.filter(F.transform(points, lambda p: p["rank"]), lambda r: r != 0))


def joined(values: Column, by: str = ",") -> Column:
    return F.array_join(F.transform(values, lambda v: v.cast("string")), by)


def tombstones(obs: DataFrame, batches: DataFrame) -> DataFrame:
    """An item that its source's next batch of the day lacks is off the list then: rank 0 at that batch."""
    w = Window.partitionBy("source_id", "crawl_date").orderBy("crawl_ts")
    following = batches.select("source_id", "crawl_date", "crawl_ts", F.lead("crawl_ts").over(w).alias("next_ts")).where("next_ts is not null")
    seen = obs.join(following, ["source_id", "crawl_date", "crawl_ts"]).select(*ITEM, F.col("next_ts").alias("crawl_ts"))
    gone = seen.join(obs.select(*ITEM, "crawl_ts"), [*ITEM, "crawl_ts"], "left_anti")
    return gone.select(*ITEM, "crawl_ts", F.date_format("crawl_ts", "HH:mm").alias("crawl_time"), F.lit(0).alias("rank"))


def timeline(obs: DataFrame, batches: DataFrame) -> DataFrame:
    """Observations and tombstones of each item; a tombstone shows if the item came back after it."""
    cols = [*ITEM, "crawl_ts", "crawl_time", "rank"]
    both = obs.select(*cols).union(tombstones(obs, batches).select(*cols))
    last = F.max(F.when(F.col("rank") > 0, F.col("crawl_ts"))).over(Window.partitionBy(*ITEM))
    return both.withColumn("last_ts", last).where("not (rank = 0 and crawl_ts > last_ts)")


def fold(obs: DataFrame) -> DataFrame:
    """The current row of each item: first and last time, count, last rank, ranks."""
    points = ordered("crawl_time", "rank")
    out = obs.groupBy(*ITEM).agg(points.alias("points"), F.count("*").alias("crawl_count"))
    at = lambda i: F.element_at("points", i)
    return out.select(*ITEM, "crawl_count", at(1)["crawl_time"].alias("first_time"), at(-1)["crawl_time"].alias("last_time"), at(-1)["rank"].alias("rank"), distinct_ranks(F.col("points")).alias("ranks"))


def is_link(title: Column) -> Column:
    return title.startswith("http://") | title.startswith("https://") | title.startswith("//")


def guarded_titles(obs: DataFrame) -> DataFrame:
    """Titles as they stand after each batch: a link never takes the place of a title."""
    w = Window.partitionBy(*ITEM).orderBy("crawl_ts")
    real = F.last(F.when(~is_link(F.col("title")), F.col("title")), ignorenulls=True).over(w)
    return obs.withColumn("title", F.coalesce(real, F.col("title")))


def title_changes(obs: DataFrame) -> DataFrame:
    w = Window.partitionBy(*ITEM).orderBy("crawl_ts")
    out = guarded_titles(obs).withColumn("old_title", F.lag("title").over(w))
    return out.where("old_title is not null and old_title <> title").select(*ITEM, "crawl_ts", "old_title", F.col("title").alias("new_title"))


def latest(rows: DataFrame, at: str) -> DataFrame:
    """Rows of the last batch over all sources. The maximum is one row, found by partial sums."""
    return rows.join(F.broadcast(rows.agg(F.max(at).alias("_latest"))), F.col(at) == F.col("_latest")).drop("_latest")


def new_since(rows: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
    """Rows of the last batch whose keys no row has that was first seen before it."""
    top = F.broadcast(rows.agg(F.max(last).alias("_latest")))
    marked = rows.crossJoin(top)
    old = marked.where(F.col(first) < F.col("_latest")).select(*keys).distinct()
    return marked.where(F.col(last) == F.col("_latest")).join(old, keys, "left_anti").drop("_latest")


def intervals(obs: DataFrame, batches: DataFrame) -> DataFrame:
    """Stretches of neighbouring batches of its source in which an item was listed."""
    of_source = Window.partitionBy("source_id", "crawl_date").orderBy("crawl_ts")
    numbered = batches.withColumn("no", F.row_number().over(of_source))
    w = Window.partitionBy(*ITEM).orderBy("no")
    runs = obs.join(numbered, ["source_id", "crawl_date", "crawl_ts"]).withColumn("run", F.col("no") - F.row_number().over(w))
    return runs.groupBy(*ITEM, "run").agg(F.min("crawl_time").alias("first_time"), F.max("crawl_time").alias("last_time"), F.count("*").alias("n")).drop("run")
