"""Tags of interests over versions: each version merges its changes into snapshots of tags, results and the ledger of analysed items.

A tag is (interest, tag, version in which it was made). An interest without active tags is met for the first time. Where the
share of changed tags reaches a threshold, all tags of the interest are made anew: the old ones and their results are
deprecated, and its ledger is emptied, so that every item is pending again. Else tags are kept (with new priorities),
removed (with their results) or added; if any is added, items that matched nothing are pending again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.rounds import checkpointed

THRESHOLD = 0.6
_TAG, _RESULT, _LEDGER = "interest string, tag string, version int, status string, priority int", "interest string, item_id long, tag string, version int, status string", "interest string, item_id long, matched boolean, version int"


@dataclass(frozen=True)
class Snapshot:
    """tags, results and ledger, as of a version."""

    tags: DataFrame
    results: DataFrame
    ledger: DataFrame


def empty(spark) -> Snapshot:
    return Snapshot(*(spark.createDataFrame([], schema) for schema in (_TAG, _RESULT, _LEDGER)))


def _order(by: str):
    return F.row_number().over(Window.partitionBy("interest").orderBy(by))  # an interest's tags, a few


def updated(s: Snapshot, wanted: DataFrame, version: int, threshold: float = THRESHOLD) -> Snapshot:
    """AI-1, ST-10, ST-11, ST-12. wanted: interest, tag, p (its place): all tags that each changed interest is to have; interests that it lacks stay."""
    active = s.tags.where("status = 'active'").select("interest", "tag", F.lit(True).alias("old"))
    both = checkpointed(active.join(wanted, ["interest", "tag"], "full").join(wanted.select("interest").distinct(), "interest"))
    kinds = both.groupBy("interest").agg(F.count_if("old").alias("before"), F.count_if(F.col("old") & F.col("p").isNotNull()).alias("kept"), F.count("*").alias("n"))
    kind = F.when(F.col("before") == 0, "first").when(1 - F.col("kept") / F.col("n") >= threshold, "full").otherwise("incremental")
    kinds = kinds.select("interest", "kept", kind.alias("kind"))
    changes = checkpointed(both.join(kinds, "interest"))
    stay = changes.where("kind = 'incremental' and old and p is not null").select("interest", "tag", _order("p").alias("to"))
    gone = changes.where("old and (kind = 'full' or p is null)").select("interest", "tag", F.lit(True).alias("gone"))
    new = changes.where("p is not null and (kind <> 'incremental' or old is null)")
    new = new.select("interest", "tag", F.lit(version).alias("version"), F.lit("active").alias("status"), (_order("p") + F.when(F.col("kind") == "incremental", F.col("kept")).otherwise(0)).cast("int").alias("priority"))
    tags = s.tags.join(stay, ["interest", "tag"], "left").join(gone, ["interest", "tag"], "left")
    live = F.col("status") == "active"
    tags = tags.select("interest", "tag", "version", F.when(live & F.col("gone"), "deprecated").otherwise(F.col("status")).alias("status"), F.when(live & F.col("to").isNotNull(), F.col("to")).otherwise(F.col("priority")).alias("priority"))
    results = s.results.join(gone, ["interest", "tag"], "left").select(*[c for c in s.results.columns if c != "status"], F.when(F.col("gone"), "deprecated").otherwise(F.col("status")).alias("status"))
    cleared = kinds.where("kind = 'full'").select("interest")
    grown = new.join(kinds.where("kind = 'incremental'"), "interest").select("interest").distinct().withColumn("grown", F.lit(True))
    ledger = s.ledger.join(cleared, "interest", "left_anti").join(grown, "interest", "left").where("grown is null or matched").drop("grown")
    return Snapshot(checkpointed(tags.unionByName(new)), results.select(*s.results.columns), ledger.select(*s.ledger.columns))


def pending(s: Snapshot, items: DataFrame) -> DataFrame:
    """JN-9: items (interest, item_id, ...) that the ledger lacks."""
    return items.join(s.ledger.select("interest", "item_id"), ["interest", "item_id"], "left_anti")


def classified(s: Snapshot, found: DataFrame, asked: DataFrame, version: int) -> Snapshot:
    """ST-12, ST-13. asked: interest, item_id of the items that were analysed; found: interest, item_id, tag of those and of active tags that match. A result that is there is left as it is."""
    active = s.tags.where("status = 'active'").select("interest", "tag", "version")
    new = found.select("interest", "item_id", "tag").distinct().join(active, ["interest", "tag"]).withColumn("status", F.lit("active"))
    new = checkpointed(new.join(s.results.select("interest", "item_id", "tag", "version"), ["interest", "item_id", "tag", "version"], "left_anti").select(*s.results.columns))
    hit = found.select("interest", "item_id").distinct().withColumn("hit", F.lit(True))
    seen = asked.select("interest", "item_id").distinct().join(hit, ["interest", "item_id"], "left").select("interest", "item_id", F.coalesce("hit", F.lit(False)).alias("matched"), F.lit(version).alias("version"))
    return Snapshot(s.tags, checkpointed(s.results.unionByName(new)), checkpointed(s.ledger.unionByName(seen)))
