"""Commits of several days, in several runs."""

from pyspark.sql import functions as F

from tidemark.sources import sinks


def _days(spark, rows, more=False):
    df = spark.createDataFrame(rows, "crawl_date string, x int")
    return df.withColumn("y", F.lit("new")) if more else df


def _seen(spark, path, version=None):
    df = sinks.committed(spark, path, version)
    return sorted((str(r.crawl_date), r.x, r.asDict().get("y")) for r in df.collect())


def test_runs(spark, tmp_path):
    path = f"{tmp_path}/store"
    sinks.stage(_days(spark, [("2024-01-01", 1), ("2024-01-02", 2)]), path, "a")
    assert sinks.manifest(spark, path).count() == 0 and _seen(spark, path) == []  # staged, not seen
    sinks.commit(spark, path, "a", 1)
    first = [("2024-01-01", 1, None), ("2024-01-02", 2, None)]
    assert _seen(spark, path) == first
    sinks.stage(_days(spark, [("2024-01-02", 9), ("2024-01-03", 9)], more=True), path, "b")  # ends here
    assert _seen(spark, path) == first
    sinks.stage(_days(spark, [("2024-01-02", 3)], more=True), path, "b")  # is written again
    sinks.commit(spark, path, "b", 2)
    sinks.commit(spark, path, "b", 2)
    assert _seen(spark, path) == [("2024-01-01", 1, None), ("2024-01-02", 3, "new")]
    assert _seen(spark, path, 1) == first
    assert sinks.manifest(spark, path).count() == 3
