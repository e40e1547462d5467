"""Messages of a bounded size, filled in order: each takes what still fits, so where one ends depends on all before it.

A unit is what isn't divided: `text` is what it adds to an open message, `fresh` what a message has that it starts. How a
stretch of units leaves the last message open depends only on how full the message was that it found, and as soon as
one is started inside the stretch on nothing before. So a stretch is a short table: up to which size the message it
finds lets the first break come where, and what is open at the end then. Tables are made for all stretches at once;
walking a key's tables in order hands the open message from stretch to stretch, and the units of all stretches are
then dealt out at once again. No key's units meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import stretches
from tidemark.operators.rounds import checkpointed
from tidemark.operators.splitting import lines_within

#: Stands for a message that takes nothing more, as before the first unit.
_FULL = 2**62


@dataclass(frozen=True)
class Breaks:
    """Where messages start in a stretch: `size` is what each unit adds, `left` how large the last message is that it starts, `extra` how many it fills before that."""

    size: np.ndarray
    left: np.ndarray
    extra: np.ndarray
    most: int

    @property
    def total(self) -> np.ndarray:
        return np.cumsum(self.size)

    def after(self, j: np.ndarray | int) -> np.ndarray:
        """The first unit that doesn't fit with what unit j starts; the number of units if all do."""
        total = self.total
        return np.maximum(np.searchsorted(total, self.most - self.left[j] + total[j], "right"), np.asarray(j) + 1)

    def first(self, size: int) -> int:
        """The first unit that doesn't fit a message of this size."""
        return int(np.searchsorted(self.total, self.most - size, "right"))

    def table(self) -> list[tuple[int, int, int, bool]]:
        """(size at most, size at the end, messages started, whether the first size is added to that at the end).

        No two have the same first entry: a unit of size 0 is never the first that doesn't fit, but after a full message.
        """
        n, total = len(self.size), self.total
        nxt = self.after(np.arange(n))
        end, started = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for j in range(n - 1, -1, -1):
            k = nxt[j]
            end[j] = end[k] if k < n else self.left[j] + total[-1] - total[j]
            started[j] = 1 + self.extra[j] + (started[k] if k < n else 0)
        out = [(int(self.most - total[-1]), int(total[-1]), 0, True)]
        for j in range(self.first(0), -1, -1):
            if j < n and (self.size[j] or not j):
                out.append((int(self.most - total[j - 1]) if j else _FULL, int(end[j]), int(started[j]), False))
        return out


def _breaks(rows: pd.DataFrame, most: int) -> tuple[pd.DataFrame, Breaks]:
    rows = rows.sort_values("at")
    return rows, Breaks(*(rows[c].to_numpy(np.int64) for c in ("size", "left", "extra")), most)


def _carried(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tables in the order of key, stretch and size, to what each stretch finds: the open message's size, and how many messages came before."""
    key, stretch, size, before, found = None, None, _FULL, 0, False
    for batch in batches:
        out: list[tuple] = []
        for k, s, upto, end, started, add in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k != key:
                key, stretch, size, before, found = k, None, _FULL, 0, True
            if s != stretch:
                stretch, found = s, False
                out.append((k, s, size, before))
            if not found and size <= upto:
                size, before, found = (size if add else 0) + end, before + started, True
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["key", "stretch", "open", "before"])


def dealt(units: DataFrame, most: int, bits: int = stretches.BITS) -> DataFrame:
    """units (key string, at, size, left, extra, and more) with `message` (from 1) and `starts`: whether the unit starts it.

    A unit that starts a message and has `extra` of its own has the last of these numbers. A key's first unit starts its first message.
    """
    units = units.withColumn("stretch", F.shiftright("at", bits))
    narrow = units.select("key", "stretch", "at", "size", "left", "extra")

    def table(rows: pd.DataFrame) -> pd.DataFrame:
        key, stretch = rows["key"].iloc[0], rows["stretch"].iloc[0]
        out = pd.DataFrame(_breaks(rows, most)[1].table(), columns=["upto", "end", "started", "adds"])
        return out.assign(key=key, stretch=stretch)[["key", "stretch", "upto", "end", "started", "adds"]]

    tables = narrow.groupBy("key", "stretch").applyInPandas(table, "key string, stretch long, upto long, end long, started long, adds boolean")
    finds = tables.repartition("key").sortWithinPartitions("key", "stretch", "upto").mapInArrow(_carried, "key string, stretch long, open long, before long")

    def deal(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        rows, b = _breaks(rows, most)
        starts = np.zeros(len(rows), bool)
        j = b.first(int(found["open"].iloc[0]))
        while j < len(rows):
            starts[j] = True
            j = int(b.after(j))
        number = int(found["before"].iloc[0]) + np.cumsum(np.where(starts, 1 + b.extra, 0))
        return pd.DataFrame({"key": rows["key"], "at": rows["at"], "message": number, "starts": starts})

    where = narrow.groupBy("key", "stretch").cogroup(finds.groupBy("key", "stretch")).applyInPandas(deal, "key string, at long, message long, starts boolean")
    return units.drop("stretch").join(where, ["key", "at"])


def packed(rows: DataFrame, key: str, order: list[str], text: str, cap: int, header: str = "", bits: int = stretches.BITS) -> DataFrame:
    """RP-8, OX-8: lines of a key in order, filled greedily into messages of at most `cap` UTF-8 bytes.

    A message starts with the header; a line that is longer than a message is one of its own. Columns: key, batch, n, bytes.
    """
    size = F.octet_length(text).cast("long") + 1
    units = rows.select(F.col(key).alias("key"), *order, size.alias("size"), (size + len(header.encode())).alias("left"), F.lit(0).cast("long").alias("extra"))
    out = dealt(stretches.numbered(units, ["key"], order).select("key", "at", "size", "left", "extra"), cap, bits)
    filled = F.sum(F.when(F.col("starts"), F.col("left")).otherwise(F.col("size")))
    return out.groupBy(F.col("key").alias(key), F.col("message").cast("int").alias("batch")).agg(F.count("*").cast("int").alias("n"), filled.cast("int").alias("bytes"))


def spaced(rows: DataFrame, key: str, at: str, order: list[str], least: int, bits: int = stretches.BITS) -> DataFrame:
    """OX-10: rows of a key, in the order of `at` (a whole number) and `order`, that come `least` or more after the last one that was taken; the first is.

    What has passed since that one is a message that is being filled: a row that would fill it to `least` starts the next."""
    placed = stretches.numbered(rows.withColumn("key", F.col(key).cast("string")), ["key"], [at, *order], name="no", bits=bits)
    following = placed.select("key", (F.col("no") + 1).alias("no"), F.col(at).alias("earlier"))
    gap = F.col(at) - F.coalesce("earlier", F.col(at))
    zero = F.lit(0).cast("long")
    units = placed.join(following, ["key", "no"], "left").select("*", F.col("no").alias("_at"), gap.cast("long").alias("size"), zero.alias("left"), zero.alias("extra"))
    out = dealt(units.select("key", F.col("_at").alias("at"), "size", "left", "extra", F.struct(*rows.columns).alias("row")), least - 1, bits)
    return out.where("starts").select("row.*")


@dataclass(frozen=True)
class Style:
    """How a channel writes a report: bold marks, what stands between groups and between regions, the foot of each message."""

    bold: str = "**"
    gap: str = "\n\n"
    rule: str = "\n\n"
    foot: str = "\n\n> 更新时间：%s"
    cap: int = 4000
    #: Around the number of a message.
    number: str = "**[第 %d/%d 批次]**\n\n"
    reverse: bool = False


#: What each channel shows and takes.
STYLES = {
    "feishu": Style(gap="\n---\n\n", rule="\n---\n\n", foot="\n\n<font color='grey'>更新时间：%s</font>", cap=30000),
    "dingtalk": Style(gap="\n---\n\n", rule="\n---\n\n", cap=20000),
    "wework": Style(gap="\n\n\n\n", rule="\n\n\n\n", foot="\n\n\n> 更新时间：%s"),
    "telegram": Style(bold="", foot="\n\n更新时间：%s", number="<b>[第 %d/%d 批次]</b>\n\n"),
    "ntfy": Style(cap=3800, reverse=True),
    "bark": Style(gap="\n\n\n\n", rule="\n\n\n\n", foot="\n\n\n> 更新时间：%s", number="[第 %d/%d 批次]\n\n", reverse=True),
    "slack": Style(bold="*", foot="\n\n_更新时间：%s_", number="*[第 %d/%d 批次]*\n\n"),
}


def reserve(style: Style) -> int:
    """RP-9: bytes that are kept for a message's number: those of the 99th of 99."""
    return len((style.number % (99, 99)).encode())


def report_units(items: DataFrame, style: Style, base: Column, room: int, bits: int = stretches.BITS) -> DataFrame:
    """RP-8: the units of reports, one report for each key.

    items: key (string), region, region_title, group_no, group_name, place (from 0), line. Regions and groups come in the order of
    their numbers. The head of a region is a unit; that of a group is one with its first line. What starts a message has the report's head
    (`base`, a column of key and total) before it, and the heads of its region and group.
    """
    regions = items.groupBy("key", "region").agg(F.count("*").alias("n"), F.count_distinct("group_no").alias("groups"), F.min("group_no").alias("first_group"), F.first("region_title").alias("region_title"))
    firsts = regions.groupBy("key").agg(F.min("region").alias("first_region"), F.sum("n").alias("total"))
    groups = items.groupBy("key", "region", "group_no").agg(F.count("*").alias("count"))
    lit, text = F.lit, lambda c: F.col(c).cast("string")
    r = regions.join(firsts, "key").withColumn("head", F.concat(lit(f"📊 {style.bold}"), "region_title", lit(f"{style.bold} (共 "), text("n"), lit(" 条)\n\n"))).withColumn("base", base)
    heads = r.select("key", "region", lit("").alias("group_no"), lit(-1).cast("long").alias("place"), F.concat(F.when(F.col("region") > F.col("first_region"), style.rule).otherwise(""), "head").alias("text"), F.concat("base", "head").alias("fresh"), "base")
    mark = F.when(F.col("count") >= 10, "🔥 ").when(F.col("count") >= 5, "📈 ").otherwise("📌 ")
    loud = F.when(F.col("count") >= 5, style.bold).otherwise("")
    own = items.drop("region_title").join(groups, ["key", "region", "group_no"]).join(r.select("key", "region", "groups", "first_group", "head", "base"), ["key", "region"])
    own = own.withColumn("group", F.concat(mark, lit(style.bold), "group_name", lit(f"{style.bold} : "), loud, text("count"), loud, lit(" 条\n\n")))
    line = F.concat(lit("  "), (F.col("place") + 1).cast("string"), lit(". "), "line", F.when(F.col("place") + 1 < F.col("count"), "\n\n").otherwise("\n"))
    begun = F.when(F.col("place") > 0, "").otherwise(F.concat(F.when(F.col("group_no") > F.col("first_group"), style.gap).otherwise(""), "group"))
    lines = own.select("key", "region", "group_no", "place", F.concat(begun, line).alias("text"), F.concat("base", "head", "group", line).alias("fresh"), "base")
    units = stretches.numbered(heads.unionByName(lines), ["key"], ["region", "group_no", "place"], bits=bits).select("key", "at", "text", "fresh", "base")
    long_ = F.octet_length("fresh") > room
    parts = F.when(long_, lines_within(room)(F.when(long_, F.col("fresh")), F.col("base"))).otherwise(F.array("fresh"))
    parts = units.withColumn("parts", parts)
    return parts.select("key", "at", "text", "parts", F.octet_length("text").cast("long").alias("size"), F.octet_length(F.element_at("parts", -1)).cast("long").alias("left"), (F.size("parts") - 1).cast("long").alias("extra"))


def reports(items: DataFrame, style: Style, base: Column, at: str, bits: int = stretches.BITS) -> DataFrame:
    """RP-8, RP-9: key, batch, sent (the number in the order of sending), body. A message with its number and foot has at most style.cap bytes.

    A report of one message has no number on it. `at` is the time that the foot shows. What is read more than once is
    checkpointed: items, units (their parts come from Python), dealt units and bodies.
    """
    foot = style.foot % at
    room = style.cap - reserve(style) - len(foot.encode())
    units = checkpointed(report_units(checkpointed(items), style, base, room, bits))
    out = checkpointed(dealt(units, room - 1, bits))
    said = F.when(F.col("starts"), F.element_at("parts", -1)).otherwise(F.col("text"))
    bodies = out.groupBy("key", "message").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", said.alias("t")))), lambda x: x["t"]), "").alias("text"))  # at most a message
    over = out.where("starts and extra > 0").select("key", (F.col("message") - F.col("extra")).alias("from"), F.posexplode(F.slice("parts", F.lit(1), F.size("parts") - 1)).alias("k", "text"))
    whole = checkpointed(bodies.unionByName(over.select("key", (F.col("from") + F.col("k")).alias("message"), "text")))
    totals = whole.groupBy("key").agg(F.count("*").alias("total"))
    rows = whole.join(totals, "key").withColumn("text", F.concat("text", F.lit(foot)))
    return sendable(rows, style)


def sendable(rows: DataFrame, style: Style) -> DataFrame:
    """RP-9: key, batch, sent, body of rows key, message (from 1), total, text: with its number, if it isn't alone, and in the order of sending."""
    number = F.format_string(style.number, "message", "total")
    body = F.when(F.col("total") > 1, F.concat(number, "text")).otherwise(F.col("text"))
    sent = F.col("total") + 1 - F.col("message") if style.reverse else F.col("message")
    return rows.select("key", F.col("message").alias("batch"), sent.alias("sent"), body.alias("body"))
