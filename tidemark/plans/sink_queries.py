"""Queries of what is written: days of titles, committed in several runs of which one fails."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.rounds import checkpointed
from tidemark.plans.catalog import query
from tidemark.sources import sinks
from tidemark.sources import tables as S
from tidemark.sources.tables import with_


@query(with_("titles", body="""SELECT CAST(date AS VARCHAR) AS day, source_id, count(*) AS n, CASE WHEN date >= DATE '2024-01-08' THEN sum(list_min(ranks))::BIGINT END AS best
FROM titles WHERE date < DATE '2024-01-20' AND (date < DATE '2024-01-08' OR source_id <> 'error') GROUP BY date, source_id"""))
def committed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1, SNK-2, SNK-3, ST-14: days of three runs: the second, with a column more, fails before its commit and is written again; the third is never committed."""
    checkpointed(spark.range(0))
    path = f"{spark.sparkContext.getCheckpointDir()}/days-{uuid.uuid4().hex}"
    t = S.titles(spark, sf_dir).select(F.col("date").alias("crawl_date"), "source_id", "title", F.array_min("ranks").alias("best"))
    between = lambda a, b: t.where(F.col("crawl_date").between(F.lit(a).cast("date"), F.lit(b).cast("date")))
    sinks.stage(between("2024-01-01", "2024-01-10").drop("best"), path, "a")
    sinks.commit(spark, path, "a", 1)
    sinks.stage(between("2024-01-08", "2024-01-12"), path, "b")  # fails here: readers still see the days of the first run
    sinks.stage(between("2024-01-08", "2024-01-19").where("source_id <> 'error'"), path, "b")
    sinks.commit(spark, path, "b", 2)
    sinks.commit(spark, path, "b", 2)
    sinks.stage(between("2024-01-01", "2024-01-30"), path, "c")
    out = sinks.committed(spark, path)
    return out.groupBy(F.col("crawl_date").cast("string").alias("day"), "source_id").agg(F.count("*").alias("n"), F.sum("best").alias("best"))
