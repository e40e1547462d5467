"""Connected components by alternating large-star and small-star steps: a distributed union-find in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: for each node of an edge other than a root, the smallest node of its component.

    A step points each node's larger neighbours at its smallest one, and the number of steps grows with the logarithm
    of a component's width. Minima are partly summed before the shuffle, and a node with many neighbours is one side of
    a join that Spark splits; each step's edges, at most as many as before, are checkpointed.
    """
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    state = _state(e)
    while state[0]:
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.union(least).distinct())
        state, old = _state(e), state
        if state == old:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
