"""Scores of ranked items as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RANK_WEIGHT, COUNT_WEIGHT, HOT_WEIGHT, HIGH_RANK = 0.6, 0.3, 0.1, 5


def weight(ranks: Column, count: Column, high: int = HIGH_RANK) -> Column:
    """TD-10: of mean rank, count and the part of high ranks; 0 without ranks."""
    n = F.size(ranks)
    rank_part = F.aggregate(ranks, F.lit(0), lambda a, r: a + (11 - F.least(r, F.lit(10)))) * 10.0 / n
    hot = F.size(F.filter(ranks, lambda r: r <= high)) * 100.0 / n
    return F.when(n > 0, RANK_WEIGHT * rank_part + COUNT_WEIGHT * 10.0 * F.least(count, F.lit(10)) + HOT_WEIGHT * hot).otherwise(0.0)


#: `weight` in SQL, of the columns ranks and n.
WEIGHT_SQL = f"""CASE WHEN len(ranks) = 0 THEN 0.0 ELSE {RANK_WEIGHT} * (list_sum(list_transform(ranks, lambda r: 11 - least(r, 10))) * 10.0 / len(ranks)) + {COUNT_WEIGHT} * 10.0 * least(n, 10)
    + {HOT_WEIGHT} * (len(list_filter(ranks, lambda r: r <= {HIGH_RANK})) * 100.0 / len(ranks)) END"""


def rank_text(ranks: Column, high: int = HIGH_RANK) -> Column:
    """TX-16: [a] or [a - b], in bold if a is a high rank."""
    low, top = F.array_min(ranks), F.array_max(ranks)
    text = F.when(low == top, F.concat(F.lit("["), low.cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("["), low.cast("string"), F.lit(" - "), top.cast("string"), F.lit("]")))
    return F.when(F.size(ranks) == 0, "").when(low <= high, F.concat(F.lit("**"), text, F.lit("**"))).otherwise(text)


def backoff(failures: Column, base: int = 60, most: int = 21600) -> Column:
    """OX-6: doubling waits."""
    return F.least(F.lit(most).cast("long"), (base * F.pow(F.lit(2.0), F.least(failures, F.lit(8)))).cast("long"))


def hotness(count: Column) -> Column:
    """RP-11."""
    return F.when(count >= 10, "hot").when(count >= 5, "warm").otherwise("")


def rank_class(rank: Column, high: int = HIGH_RANK) -> Column:
    return F.when(rank <= 3, "top").when(rank <= high, "high").otherwise("")
