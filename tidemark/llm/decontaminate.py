"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every run of `window` consecutive words of a benchmark item is a pattern; an item of fewer words, but not none, is one
pattern as a whole. Patterns of one length share a table: for each block of two words, how far the search may move on
without passing the end of a pattern that holds the block. Where it may not move, the block ends a pattern: the bucket
of its hash has those patterns, and their words are compared one by one. Many stretches of text are searched at once,
each with a place of its own, so that numpy does the steps.

The benchmark is sent to all tasks in parts of a bounded size (PART_CHARS); more parts mean more passes over the texts.

Cases: a null text has no words. An item with a null id marks words, and is in no list of items. Repeated rows are
judged each. A null doc_id stays null. Empty tables: no document gives no row, no item gives rows without hits. A text
of any length is searched whole. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tables import cut, keyed, prepare, unkeyed
from tidemark.llm.words import LOWER, NOT_ALNUM, Words, buffers, chunks, words_of

#: Characters of benchmark text that are broadcast at once; about 14 bytes of tables a character.
PART_CHARS = 4_000_000
#: Words that one place of the search goes through.
STRETCH = 256
_LEAST_BITS = 16
_OUT = {"n_words": "long", "spans": "array<struct<start:int,end:int>>", "items": "array<{kind}>"}
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _block(last: np.ndarray, before: np.ndarray) -> np.ndarray:
    return last * np.uint64(0x9E3779B97F4A7C15) ^ (before >> np.uint64(7)) * np.uint64(0xC2B2AE3D27D4EB4F)


def _slot(block: np.ndarray, bits: int) -> np.ndarray:
    return (block >> np.uint64(64 - bits)).astype(np.int64)


class Table:
    """The patterns of one length: shifts by block, buckets by the last block."""

    def __init__(self, hashes: np.ndarray, texts: list[bytes], items: list[list[int]]):
        self.size = m = hashes.shape[1]
        ends = self._blocks(hashes, m - 1)
        order = np.argsort(ends, kind="stable")
        self.hashes, self.ends = hashes[order], ends[order]
        self.texts, self.items = [texts[i] for i in order], [items[i] for i in order]
        wide = min(m, 2)
        #: Eight slots for each block of the patterns, so that most blocks of a text have none of them in their slot.
        self.bits = max(_LEAST_BITS, (8 * (m - wide + 1) * len(hashes)).bit_length())
        self.shift = np.full(1 << self.bits, m - wide + 1, np.int8 if m < 128 else np.int64)
        for last in range(wide - 1, m):
            np.minimum.at(self.shift, _slot(self._blocks(hashes, last), self.bits), m - 1 - last)

    @staticmethod
    def _blocks(hashes: np.ndarray, last: int) -> np.ndarray:
        return _block(hashes[:, last], hashes[:, last - 1] if last else np.zeros(len(hashes), np.uint64))

    def find(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of last words, and the patterns whose word hashes end there. first: as in Words."""
        m = self.size
        low, high = first[:-1] + m - 1, first[1:]
        parts = np.maximum(0, -(-(high - low) // STRETCH))
        which = np.repeat(np.arange(len(low)), parts)
        step = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
        at = low[which] + step * STRETCH
        stop = np.minimum(at + STRETCH, high[which])
        found = []
        while len(at):
            block = _block(hashes[at], hashes[at - 1] if m > 1 else np.zeros(len(at), np.uint64))
            shift = self.shift[_slot(block, self.bits)].astype(np.int64)
            here = shift == 0
            found.append((at[here], block[here]))
            at = at + np.maximum(shift, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, block = (np.concatenate(x) for x in zip(*found, strict=True))
        left, right = np.searchsorted(self.ends, block, "left"), np.searchsorted(self.ends, block, "right")
        n = right - left
        at = np.repeat(at, n)
        pattern = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(left, n)
        for k in [m - 1, *range(m - 1)]:
            same = hashes[at - m + 1 + k] == self.hashes[pattern, k]
            at, pattern = at[same], pattern[same]
        return at, pattern


def tables(items: list[tuple[int | None, str | None]], window: int) -> list[Table]:
    """Of (item_id, text): one table for each length of pattern."""
    column = pa.array([x or "" for _, x in items], pa.string())
    if not len(column):
        return []
    data, offsets = buffers(column)
    words = words_of(LOWER[data], offsets, NOT_ALNUM)
    hashes = words.hashes()
    patterns: dict[int, dict[bytes, tuple[np.ndarray, list[int]]]] = {}
    for i, (item, _) in enumerate(items):
        a, b = int(words.first[i]), int(words.first[i + 1])
        size = min(window, b - a)
        for k in range(a, b - size + 1) if size else ():
            entry = patterns.setdefault(size, {}).setdefault(b" ".join(words.bytes_of(k, k + size)), (hashes[k : k + size], []))
            if item is not None and item not in entry[1]:
                entry[1].append(item)
    return [Table(np.array([x[0] for x in found.values()]), list(found), [x[1] for x in found.values()]) for _, found in sorted(patterns.items())]


def _search(words: Words, of: list[Table]) -> tuple[np.ndarray, list[set[int]]]:
    """Which words are hit, and the items found in each text."""
    hashes, n = words.hashes(), len(words.start)
    edges = np.zeros(n + 1, np.int64)
    items: list[set[int]] = [set() for _ in words.count]
    for table in of:
        ends, patterns = table.find(hashes, words.first)
        doc = np.searchsorted(words.first, ends, "right") - 1
        for e, p, d in zip(ends.tolist(), patterns.tolist(), doc.tolist(), strict=True):
            a = e - table.size + 1
            text = table.texts[p]
            if words.data[words.start[a] : words.end[e]].tobytes() == text or b" ".join(words.bytes_of(a, e + 1)) == text:
                edges[a] += 1
                edges[e + 1] -= 1
                items[d].update(table.items[p])
    return np.cumsum(edges[:-1]) > 0, items


def _pass(sent, first_pass: bool, kind: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = sent.value
        for batch in batches:
            texts = batch.column("_text")
            for row, stop, data, offsets in chunks(texts):
                words = words_of(LOWER[data], offsets, NOT_ALNUM)
                hit, items = _search(words, of)
                count = words.count
                if not first_pass:
                    for i, spans in enumerate(batch.column("spans").slice(row, stop - row).to_pylist()):
                        for s in spans:
                            hit[words.first[i] + s["start"] : words.first[i] + s["end"]] = True
                    items = [a.union(b) for a, b in zip(items, batch.column("items").slice(row, stop - row).to_pylist(), strict=True)]
                spans = [[] for _ in count]
                for i in np.unique(np.searchsorted(words.first, np.flatnonzero(hit), "right") - 1):
                    own = np.diff(hit[words.first[i] : words.first[i + 1]].astype(np.int8), prepend=0, append=0)
                    spans[i] = [{"start": a, "end": b} for a, b in zip(np.flatnonzero(own == 1).tolist(), np.flatnonzero(own == -1).tolist(), strict=True)]
                own = [c for c in batch.schema.names if c not in _OUT]
                found = [pa.array(count, pa.int64()), pa.array(spans, _SPANS), pa.array([sorted(x) for x in items], pa.list_(pa.string() if kind == "string" else pa.int64()))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(row, stop - row) for c in own), *found], [*own, *_OUT])

    return run


def _searched(rows: DataFrame, benchmark: DataFrame, window: int, item_col: str, item_text_col: str, part_chars: int) -> DataFrame:
    """rows (with _text) and n_words, spans, items. No shuffle: each text alone, against all patterns."""
    spark = rows.sparkSession
    prepare(spark)
    kind = "string" if dict(benchmark.dtypes)[item_col] == "string" else "long"
    bench = benchmark.select(benchmark[item_col].cast(kind).alias("item"), F.coalesce(benchmark[item_text_col], F.lit("")).alias("words"))
    chars = bench.agg(F.coalesce(F.sum(F.length("words")), F.lit(0))).first()[0]
    parts = max(1, -(-chars // part_chars))
    schema = T.StructType([*rows.schema.fields, *(T.StructField(k, T._parse_datatype_string(v.format(kind=kind))) for k, v in _OUT.items())])
    for part in range(parts):
        items = bench.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == part) if parts > 1 else bench
        sent = spark.sparkContext.broadcast(tables([tuple(x) for x in items.collect()], window))  # about part_chars of text
        rows = rows.mapInArrow(_pass(sent, part == 0, kind), schema)
        if part + 1 < parts:
            rows = cut(rows)
            sent.unpersist()
    return rows


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """doc_id, n_words, spans (runs of hit words: first, after the last), items (ids found in it)."""
    found = _searched(keyed(docs, id_col, text_col), benchmark, window, item_col, item_text_col, part_chars)
    return found.select(unkeyed().alias("doc_id"), "n_words", "spans", "items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """The rows of docs in which no word is hit, with all their columns."""
    rest = F.struct(*[F.col("`" + c.replace("`", "``") + "`").alias(c) for c in docs.columns if c != text_col])
    rows = docs.select(F.coalesce(docs[text_col], F.lit("")).alias("_text"), F.struct(rest.alias("rest"), docs[text_col].isNull().alias("no_text")).alias("_row"))
    clean = _searched(rows, benchmark, window, item_col, item_text_col, part_chars).where(F.size("spans") == 0)
    text = F.when(~F.col("_row.no_text"), F.col("_text"))
    return clean.select(*[text.alias(c) if c == text_col else F.col("_row.rest").getField(c).alias(c) for c in docs.columns])


def contamination(docs: DataFrame, benchmark: DataFrame, **more) -> DataFrame:
    """find_benchmark with its counts and digest."""
    found = find_benchmark(docs, benchmark, **more)
    items = F.array_sort(F.col("items").cast("array<string>"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.size("items") + F.size("spans") > 0).alias("contaminated"))


