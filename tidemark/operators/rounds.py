"""Order-dependent choices over pairs, decided in rounds."""

from __future__ import annotations

import tempfile
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the folder of spark.checkpoint.dir; a folder of our own only where that is unset, as in tests."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="tidemark-rounds-"))
    return df.checkpoint()


def leaders(items: DataFrame, near: DataFrame) -> DataFrame:
    """title, leader. near: (lead, lead_k, member, member_k) with lead before member in the order of k.

    An item leads if no item before it that it is near to leads; else its leader is the first such. Every round decides
    all items whose nearer-to-front neighbours are decided, so the rounds are as many as the longest chain of neighbours.
    """
    alone = items.join(near.select(F.col("member").alias("title")).distinct(), "title", "left_anti")
    decided = [checkpointed(alone.select("title", F.lit(True).alias("leads"), F.col("title").alias("leader")))]
    left = near.select("lead", "lead_k", "member", F.lit(None).cast("boolean").alias("leads"))
    while True:
        known = decided[-1].select(F.col("title").alias("lead"), F.col("leads").alias("now"))
        left = checkpointed(left.join(known, "lead", "left").select("lead", "lead_k", "member", F.coalesce("leads", "now").alias("leads")))
        votes = left.groupBy("member").agg(F.min_by("lead", F.when(F.col("leads"), F.col("lead_k"))).alias("leader"), F.min(F.when(F.col("leads"), F.col("lead_k"))).alias("first"), F.min(F.when(F.col("leads").isNull(), F.col("lead_k"))).alias("open"))
        sure = votes.where("open is null or first < open")
        new = checkpointed(sure.select(F.col("member").alias("title"), F.col("first").isNull().alias("leads"), F.when(F.col("first").isNull(), F.col("member")).otherwise(F.col("leader")).alias("leader")))
        if new.isEmpty():
            return reduce(DataFrame.unionByName, decided).select("title", "leader")
        decided.append(new)  # rounds write what they decide, and no more
        left = left.join(new.select(F.col("title").alias("member")), "member", "left_anti")
