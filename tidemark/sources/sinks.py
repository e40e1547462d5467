"""Where results go: date partitions, text snapshots, reports. All are written by Spark, to any store that it writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import html_escape


def write_days(df: DataFrame, path: str, day: str = "crawl_date") -> None:
    """SNK-1, SNK-2, SNK-3: replaces the days that df has and no others, in one commit."""
    df.repartition(day).write.partitionBy(day).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_days(spark, path: str, schema: str | None = None) -> DataFrame:
    """ST-14: all days of a table; a column that older days lack is null there."""
    reader = spark.read.option("mergeSchema", "true")
    return (reader.schema(schema) if schema else reader).parquet(path)


def stage(df: DataFrame, path: str, run: str, day: str = "crawl_date") -> None:
    """SNK-3: writes the days of df as those of a run. Nobody sees them before they are committed, and writing a run again replaces what was left of it."""
    df.repartition(day).write.partitionBy(day).mode("overwrite").parquet(f"{path}/data/run={run}")


def commit(spark, path: str, run: str, version: int, day: str = "crawl_date") -> None:
    """SNK-1, SNK-2, SNK-3: makes all days of a staged run those that readers see, at once: one row for each day is appended to the manifest.

    A run that is committed already is left as it is, so a commit can be repeated."""
    days = spark.read.option("mergeSchema", "true").parquet(f"{path}/data/run={run}").select(F.col(day).cast("string").alias("day")).distinct()
    rows = days.select("day", F.lit(run).alias("run"), F.lit(version).alias("version"))
    if manifest(spark, path).where(F.col("run") == run).isEmpty():
        rows.coalesce(1).write.mode("append").parquet(f"{path}/manifest")


_MANIFEST = "day string, run string, version int"


def manifest(spark, path: str) -> DataFrame:
    """day, run, version of all commits; none before the first."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def committed(spark, path: str, version: int | None = None, day: str = "crawl_date") -> DataFrame:
    """ST-14: each day as its last commit has it, or the last up to a version; a column that a day's run lacks is null there."""
    m = manifest(spark, path)
    m = m if version is None else m.where(F.col("version") <= version)
    last = m.groupBy("day").agg(F.max_by("run", "version").alias("run"))
    data = spark.read.option("mergeSchema", "true").parquet(f"{path}/data")
    return data.withColumn("day", F.col(day).cast("string")).withColumn("run", F.col("run").cast("string")).join(last, ["day", "run"], "left_semi").drop("day", "run")


def report_lines(report: DataFrame, group: str, place: str, title: str, url: str, note: Column) -> DataFrame:
    """SNK-5, SNK-6: one line of HTML for each group's head and each of its titles, with its place: (group, place, line)."""
    text = lambda c: html_escape(F.coalesce(F.col(c).cast("string"), F.lit("")))
    item = F.concat(F.lit('<li><a href="'), text(url), F.lit('">'), text(title), F.lit("</a> <small>"), html_escape(note), F.lit("</small></li>"))
    heads = report.groupBy(group).agg(F.count("*").alias("n")).select(group, F.lit(0).alias("place"), F.concat(F.lit("<h2>"), text(group), F.lit(" ("), F.col("n").cast("string"), F.lit(")</h2>")).alias("line"))
    return heads.unionByName(report.select(group, F.col(place).cast("int").alias("place"), item.alias("line")))


def write_report(lines: DataFrame, path: str, group: str) -> None:
    """A report's lines as text files, groups by range and in order inside."""
    lines.repartitionByRange(group, "place").sortWithinPartitions(group, "place").select("line").write.mode("overwrite").text(path)
