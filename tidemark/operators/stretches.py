"""Order within a key without the key's rows in one task: rows sorted by ranges, numbered in stretches of a bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.rounds import checkpointed

#: A stretch has at most 2 to this power rows of a key.
BITS = 12


def before(rows: DataFrame, keys: list[str], stretch: str, **sums: str) -> DataFrame:
    """keys, stretch, and for each name the sum of that expression over all earlier stretches of the key; a key's first stretch is left out."""
    w = Window.partitionBy(*keys).orderBy(stretch)  # a row for each stretch
    whole = rows.groupBy(*keys, stretch).agg(*[F.expr(e).alias(n) for n, e in sums.items()])
    run = [F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias(f"{n}_before") for n in sums]
    return whole.select(*keys, stretch, F.row_number().over(w).alias("_no"), *run).where("_no > 1").drop("_no")


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str = "at", bits: int | None = None) -> DataFrame:
    """rows with their number from 0 within their keys, in the order of `order`, and a checkpoint behind it.

    The sort is by ranges of keys and order, so a key with many rows is dealt to many tasks. A stretch has rows that are
    neighbours in one task; what counts those before it is one number a stretch. Keys are not null.
    """
    s = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    s = checkpointed(s.withColumn("_id", F.monotonically_increasing_id())).withColumn("_stretch", F.shiftright("_id", BITS if bits is None else bits))
    local = F.row_number().over(Window.partitionBy(*keys, "_stretch").orderBy("_id")) - 1
    out = s.withColumn("_local", local).join(before(s, keys, "_stretch", n="count(*)"), [*keys, "_stretch"], "left")
    return out.withColumn(name, F.col("_local") + F.coalesce("n_before", F.lit(0))).drop("_id", "_stretch", "_local", "n_before")
