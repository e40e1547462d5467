"""Documents packed into sequences of a bounded number of tokens: large ones matched in pairs, small ones by best fit.

Texts are encoded where they are read and written once as pieces; only documents that are longer than a sequence are
cut. What decides how pieces meet is their lengths alone, and of these there are at most as many as a sequence has
tokens. So the plan is made of counts by length, in bulk, and its size and time don't depend on the number of
documents:

- Large pieces, of over a third of a sequence, meet at most twice in one. From the longest down each takes the longest
  other large one that fits, which gives the fewest sequences for them.
- Small pieces, from the longest down, go where the least room is left that holds them. All pieces of a length are
  placed together: a stretch of sequences with equal room takes as many of them each as fit, as one by one they would.

A plan has a row for each stretch that a length goes to. A stretch that is used up leaves less than half its room, and
each length splits at most one, so there are O(capacity x log(capacity)) rows: some 4 MB at most for 4096 tokens, which every
task may hold. A piece finds its row by its number among the pieces of its length: those of all parts of the table
before its own, a sum of counts by part and length, and its number in the part, which was written with it. No length's
pieces ever meet in a task.

Cases: a null text is an empty document, which has the end id only; a null doc_id stays null. Repeated rows are packed
each by itself. An empty table gives no piece. Other columns are ignored. Pieces of one length are dealt to the places
for it in the order of the table's parts, so sequence numbers depend on how the input is split; their count doesn't.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import prepare
from tidemark.llm.word_bpe import CHUNK, word_encoder
from tidemark.llm.words import chunks

CAPACITY = 4096
#: Rows in a batch of pieces.
_ROWS = 1000
_PIECES = "doc_id long, piece int, start long, length long, part int, number long, ids binary"
_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("part", pa.int32()), ("number", pa.int64()), ("ids", pa.binary())])


def _numbered(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The number of each piece among those of its length; seen: how many there were before, which is brought up to date."""
    order = np.argsort(length, kind="stable")
    ranked = length[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    out = np.empty(len(length), np.int64)
    out[order] = np.arange(len(length)) - np.repeat(first, np.diff(np.append(first, len(length))))
    out += seen[length]
    seen += np.bincount(length, minlength=len(seen))
    return out


def _cut(tokenizer_file: str, end_id: int, capacity: int, width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_encoder(tokenizer_file), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column(1), CHUNK):
                ids, bounds = encoder.encode(data, offsets)
                ids = np.insert(ids, bounds[1:], end_id).astype(f"<u{width}")
                size = np.diff(bounds) + 1
                many = -(-size // capacity)
                doc = np.repeat(np.arange(b - a), many)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                length = np.minimum(capacity, size[doc] - piece * capacity)
                number, to = _numbered(length, seen), np.cumsum(length)
                keys = batch.column(0)[a:b].take(pa.array(doc))
                for x in range(0, len(doc), _ROWS):
                    y = min(x + _ROWS, len(doc))
                    own = slice(x, y)
                    begin = to[x] - length[x]
                    ends = np.append(0, to[own] - begin) * width
                    body = pa.Array.from_buffers(pa.binary(), y - x, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids[begin : to[y - 1]].tobytes())])
                    yield pa.RecordBatch.from_arrays([keys[own], pa.array(piece[own], pa.int32()), pa.array(piece[own] * capacity), pa.array(length[own]), pa.array(np.full(y - x, part, np.int32)), pa.array(number[own]), body], schema=_ARROW)

    return run


def id_width(vocabulary: int, end_id: int) -> int:
    return 2 if max(vocabulary - 1, end_id) < 2**16 else 4


def write_pieces(docs: DataFrame, path: str, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = CAPACITY, vocabulary: int = 49408) -> None:
    """Encodes every text, appends end_id, cuts what is longer than `capacity`, and writes the pieces to a new table at `path`.

    Columns: doc_id, piece, start, length, ids (little-endian, id_width bytes each), part and number (of the piece among those of
    its length in its part).
    """
    prepare(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_text"))
    rows.mapInArrow(_cut(tokenizer_file, end_id, capacity, id_width(vocabulary, end_id)), _PIECES).write.parquet(path)


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_PIECES).parquet(path)


def crc32_of(ids: Column, width: int) -> Column:
    """The unsigned crc32 of ids as little-endian unsigned 32-bit integers."""

    @F.pandas_udf("long")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([zlib.crc32(np.frombuffer(x, f"<u{width}").astype("<u4")) for x in values], dtype="int64")

    return run(ids)


class Plan:
    """Where the pieces of each length go. A row: pieces `rank` to `rank + n` of a length, `each` to a sequence from `sequence` on, the first at `offset`."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.sequences = capacity, 0
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.placed = [0] * (capacity + 1)
        #: Sequences with some room left, as (first, how many), by room; and those rooms in order.
        self.room: dict[int, list[tuple[int, int]]] = {}
        self.rooms: list[int] = []
        left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            left[length] = n
        self._pair(left, capacity // 3)
        for length in range(capacity // 3, 0, -1):
            self._fit(length, int(left[length]))

    def _put(self, length: int, n: int, each: int, sequence: int, offset: int) -> None:
        self.rows.append((length, self.placed[length], n, each, sequence, offset))
        self.placed[length] += n

    def _leave(self, room: int, first: int, n: int) -> None:
        if room and n:
            if room not in self.room:
                self.room[room] = []
                insort(self.rooms, room)
            self.room[room].append((first, n))

    def _pair(self, left: np.ndarray, third: int) -> None:
        for x in range(self.capacity, third, -1):
            while left[x]:
                most = min(x if left[x] > 1 else x - 1, self.capacity - x)
                others = np.flatnonzero(left[third + 1 : most + 1])
                y = third + 1 + int(others[-1]) if len(others) else 0
                n = int(left[x]) if not y else int(left[x]) // 2 if y == x else int(min(left[x], left[y]))
                first, self.sequences = self.sequences, self.sequences + n
                self._put(x, n, 1, first, 0)
                left[x] -= n
                if y:
                    self._put(y, n, 1, first, x)
                    left[y] -= n
                self._leave(self.capacity - x - y, first, n)

    def _fit(self, length: int, n: int) -> None:
        while n:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                first, need = self.sequences, -(-n // (self.capacity // length))
                self.sequences += need
                self._leave(self.capacity, first, need)
                continue
            room = self.rooms[at]
            first, many = self.room[room].pop()
            if not self.room[room]:
                del self.room[room], self.rooms[at]
            each, offset = room // length, self.capacity - room
            full = min(many, n // each)
            if full:
                self._put(length, full * each, each, first, offset)
                self._leave(room - each * length, first, full)
                n -= full * each
            if full < many and n:  # the last of them, in part of one sequence's room
                self._put(length, n, n, first + full, offset)
                self._leave(room - n * length, first + full, 1)
                n, full = 0, full + 1
            self._leave(room, first + full, many - full)

    def finder(self):
        """A function of a piece's length and number: (sequence, offset), for arrays."""
        table = np.array(sorted(self.rows), np.int64).reshape(-1, 6)
        shift = 63 - int(self.capacity).bit_length()
        key = table[:, 0] << shift | table[:, 1]

        def find(length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            row = table[np.searchsorted(key, length << shift | number, "right") - 1]
            k = number - row[:, 1]
            return row[:, 4] + k // row[:, 3], row[:, 5] + k % row[:, 3] * length

        return find


def plan_of(pieces: DataFrame, capacity: int = CAPACITY) -> Plan:
    """The plan for a table of pieces; one count for each length, at most `capacity` of them, meets on the driver."""
    return Plan({r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}, capacity)


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (of a written table, with any further columns) with sequence_id and offset, without part and number."""
    find = plan_of(pieces, capacity).finder()

    @F.pandas_udf("sequence_id long, offset long")
    def where(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = find(length.to_numpy(np.int64), number.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    parts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    starts = parts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = pieces.join(starts, ["part", "length"]).withColumn("place", where("length", F.col("before") + F.col("number")))
    return own.select(*[c for c in pieces.columns if c not in ("part", "number")], "place.sequence_id", "place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length, ids: the ids of all pieces of each sequence, in order; packed: `placed` with ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most a sequence
    ids = F.aggregate(F.transform(parts, lambda x: x["ids"]), F.lit(b""), lambda a, x: F.concat(a, x))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), ids.alias("ids"))
