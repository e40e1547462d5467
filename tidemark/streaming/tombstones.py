"""Items that leave a list, as events of a stream: keyed state with timers.

A source's batch is complete when the watermark has passed its hour; then the items of its batch before, on the same day,
that it lacks are off the list. Items of a source are dealt to SHARDS keys, so that a large source isn't one task's; each of
these is told of every batch by a beat, one row for each batch and shard, as a batch may have none of its items.
State holds, for each key, the last complete batch and those that are still open.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SHARDS = 4
_HOUR, _DAY = 3_600_000, 86_400_000
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OUT = "source_id string, item_key long, crawl_ts timestamp"


class OffList(StatefulProcessor):
    """Rows (hour in milliseconds, item or -1 for a beat) of a source's shard to its items that the next batch lacks."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.batches = handle.getMapState("batches", "hour long", "items array<long>")
        self.last = handle.getValueState("last", "hour long, items array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for hour, items in pdf.groupby("hour")["item_key"]:
                hour = int(hour)
                known = set(self.batches.getValue((hour,))[0]) if self.batches.containsKey((hour,)) else set()
                known |= {int(x) for x in items if x >= 0}
                self.batches.updateValue((hour,), (sorted(known),))
                self.handle.registerTimer(hour + _HOUR)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        done = sorted(hour for (hour,), _ in self.batches.iterator() if hour + _HOUR <= passed)
        last = self.last.get() if self.last.exists() else None
        out = []
        for hour in done:
            items = list(self.batches.getValue((hour,))[0])
            self.batches.removeKey((hour,))
            if last and last[0] // _DAY == hour // _DAY:
                out += [(key[0], x, hour) for x in sorted(set(last[1]).difference(items))]
            last = (hour, items)
        if done:
            self.last.update(last)
        if out:
            pdf = pd.DataFrame(out, columns=["source_id", "item_key", "crawl_ts"])
            yield pdf.assign(crawl_ts=pd.to_datetime(pdf["crawl_ts"], unit="ms"))

    def close(self) -> None:
        pass


def off_list(events: DataFrame, shards: int = SHARDS) -> DataFrame:
    """SM-3: source_id, item_key, crawl_ts; events: a stream (source_id, item_key, ts) with a watermark on ts."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)  # the one that keeps maps and timers
    hour = (F.unix_millis(F.date_trunc("hour", "ts"))).alias("hour")
    seen = events.select("source_id", F.pmod("item_key", F.lit(shards)).cast("int").alias("shard"), hour, "item_key", "ts")
    beats = events.select("source_id", hour, "ts").dropDuplicatesWithinWatermark(["source_id", "hour"])
    beats = beats.select("source_id", F.explode(F.array(*map(F.lit, range(shards)))).alias("shard"), "hour", F.lit(-1).cast("long").alias("item_key"), "ts")
    return seen.unionByName(beats).groupBy("source_id", "shard").transformWithStateInPandas(OffList(), _OUT, "append", "EventTime")
