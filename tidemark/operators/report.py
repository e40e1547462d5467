"""Keyword reports over titles (date, source_id, title, n, ranks, pos, first_ts, last_ts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scores import weight
from tidemark.plans.rules import Rules, group_of


def groups_table(df: DataFrame, rules: Rules) -> DataFrame:
    """position, group, most: one row for each rule group."""
    return df.sparkSession.createDataFrame([(i, g.name, g.most) for i, g in enumerate(rules.groups)], "position int, word string, most int")


def matched(titles: DataFrame, rules: Rules) -> DataFrame:
    """Titles that a group takes, with position and weight."""
    out = titles.withColumn("position", group_of(rules, F.col("title"), position=True)).where("position is not null")
    return out.withColumn("weight", F.round(weight(F.col("ranks"), F.col("n")), 6))


def order():
    """OR-1: by weight, best rank and count; title and source break ties."""
    return [F.desc("weight"), F.coalesce(F.array_min("ranks"), F.lit(999)), F.desc("n"), F.col("title"), F.col("source_id"), F.col("date")]


def grouped(titles: DataFrame, rules: Rules, most: int = 0) -> DataFrame:
    """AG-4, WN-2: titles of each group in order, cut to the group's limit; count and percentage are of all."""
    found = matched(titles, rules)
    w = Window.partitionBy("position").orderBy(*order())
    counts = found.groupBy("position").agg(F.count("*").alias("count"))
    total = titles.agg(F.count("*").alias("total"))
    limit = F.when(F.col("most") > 0, F.col("most")).otherwise(F.lit(most))
    ranked = found.withColumn("place", F.row_number().over(w)).join(F.broadcast(groups_table(titles, rules)), "position")
    ranked = ranked.where((limit == 0) | (F.col("place") <= limit))
    out = ranked.join(F.broadcast(counts), "position").crossJoin(F.broadcast(total))
    return out.withColumn("percentage", F.round(F.col("count") * 100 / F.col("total"), 2))


def group_counts(titles: DataFrame, rules: Rules) -> DataFrame:
    """Counts of all groups, those of none included."""
    counts = matched(titles, rules).groupBy("position").agg(F.count("*").alias("c"))
    total = titles.agg(F.count("*").alias("total"))
    out = groups_table(titles, rules).join(counts, "position", "left").crossJoin(F.broadcast(total)).withColumn("count", F.coalesce("c", F.lit(0)))
    return out.select("position", "word", "count", F.round(F.when(F.col("total") > 0, F.col("count") * 100 / F.col("total")).otherwise(0.0), 2).alias("percentage"))
