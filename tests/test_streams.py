"""Streams in several runs: what is late stays out, what leaves a list is told once."""

import random
import uuid
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.streaming import tombstones, views

START = datetime(2024, 1, 1)


def test_a_late_row_stays_out(spark):
    at = lambda days, hours=0: START + timedelta(days=days, hours=hours)
    first = [(1, at(0), "a"), (2, at(0, 5), "a"), (3, at(4, 1), "b"), (4, at(9), "a")]
    second = [(5, at(0, 7), "a"), (6, at(8), "a"), (7, at(30), "z")]  # of a day that is closed, of one that is open, and one that closes it
    frames = [spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string") for rows in (first, second)]
    got = {(r.day, r.event_type): r.n for r in views.late_counts(frames).collect()}
    assert got == {("2024-01-01", "a"): 2, ("2024-01-05", "b"): 1, ("2024-01-09", "a"): 1, ("2024-01-10", "a"): 1}


def _off(rows, passed):
    """Items of each source that its next batch of the day lacks, batch by batch; passed: the last hour that counts."""
    batches = defaultdict(lambda: defaultdict(set))
    for source, item, ts in rows:
        batches[source][ts.replace(minute=0, second=0)].add(item)
    out = []
    for source, hours in batches.items():
        order = sorted(hours)
        for a, b in zip(order, order[1:], strict=False):
            if a.date() == b.date() and b <= passed:
                out += [(source, x, b) for x in hours[a] - hours[b]]
    return sorted(out)


def test_tombstones_over_several_runs(spark):
    """Items come in three runs; each run goes on from the state of the one before."""
    rng = random.Random(6)
    rows = [(s, x, START + timedelta(hours=h, minutes=rng.randrange(60))) for s in ("one", "two") for h in range(60) if rng.random() < 0.7 for x in range(8) if rng.random() < 0.6]
    rows.sort(key=lambda r: r[2])
    end = rows[-1][2]
    views.checkpointed(spark.range(0))
    base = f"{spark.sparkContext.getCheckpointDir()}/test-{uuid.uuid4().hex}"
    cut = [0, len(rows) // 3, len(rows) // 2, len(rows)]
    for a, b in zip(cut, cut[1:], strict=False):
        spark.createDataFrame(rows[a:b], "source_id string, item_key long, ts timestamp").write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("source_id string, item_key long, ts timestamp").parquet(f"{base}/in").withWatermark("ts", "3 hours")
        q = tombstones.off_list(stream, shards=3).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    got = sorted((r.source_id, r.item_key, datetime.strptime(r.at, "%Y-%m-%d %H:%M")) for r in spark.read.parquet(f"{base}/out").select("source_id", "item_key", F.date_format("crawl_ts", "yyyy-MM-dd HH:mm").alias("at")).collect())
    last = end - timedelta(hours=4)
    expected = _off(rows, last)
    assert [r for r in got if r[2] <= last - timedelta(minutes=59)] == [r for r in expected if r[2] <= last - timedelta(minutes=59)] and set(got) >= set(expected) and len(got) == len(set(got))
