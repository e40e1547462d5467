"""Runs of repeated words, found online: catchers over completed power-of-two blocks report squares, which merge into runs.

A run is a longest stretch of words with a smallest period q, of at least LEAST words and TIMES periods. Of a run of
period q, three neighbouring aligned blocks of b words, with b from 3q/8 to 3q/4, stand before their own repetition q
words on. So as words are appended, each completed block of b words waits for its repetitions at distances over 4b/3
and up to 8b/3: its catcher compares one hash with those of the stretches that the new words complete. Where
neighbouring catchers report the same distance, a square has been found; comparing words to its left gives where its
run begins, and comparing each appended word with that q before it says how long the run goes on.

Each append takes any number of words, the catchers of a level together, as arrays; the result doesn't depend on how the words
come in. Hashes of blocks are made of those of their halves, and a level keeps them only as far back as its blocks
still wait, so memory grows with the longest period, not with the text. Time is n x log(n) hash comparisons.

Short documents are appended to one stream, with a word of its own after each. What a stream reports is compared in the
bytes of the words; a document in which hashes were wrong is done anew with exact word numbers.

Cases: a null text has no words, no runs and an empty collapsed text, like an empty one. A null doc_id stays null.
Repeated rows are judged each by itself. An empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import prepare
from tidemark.llm.words import SPACE, chunks, mix, words_of

#: Words and periods that a run has at least. Catchers rely on four periods.
LEAST, TIMES = 6, 4
#: Words that a stream is given at once.
PIECE = 1 << 16

_SEED = np.uint64(0x9E3779B97F4A7C15)


class _Level:
    """Catchers of the blocks of b words."""

    def __init__(self, b: int):
        self.b, self.lo, self.hi, self.need = b, 4 * b // 3 + 1, 8 * b // 3, 3
        if b == 1:  # periods 1 and 2
            self.lo, self.need = 1, 5
        self.at = self.block = 0  # the words before hashes[0], and before the next block that waits
        self.hashes = np.zeros(0, np.uint64)
        width = self.hi - self.lo + 1
        self.rows, self.found = np.zeros((self.need - 1, width), bool), np.zeros((1, width), bool)

    def hashed(self) -> int:
        return self.at + len(self.hashes)

    def squares(self, n: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
        """Where blocks and distances begin to agree, of those blocks of the first n words that have met all their distances, or of all."""
        many = (n - (0 if last else self.hi) - self.b - self.block) // self.b + 1
        if many <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = self.hashes[self.block - self.at :]
        need = (many - 1) * self.b + self.hi + 1
        if need > len(h):  # beyond the last word nothing agrees
            h = np.concatenate([h, mix(np.arange(need - len(h), dtype=np.uint64) + _SEED)])
        later = np.lib.stride_tricks.as_strided(h[self.lo :], (many, self.hi - self.lo + 1), (8 * self.b, 8))
        rows = np.concatenate([self.rows, later == h[: (many - 1) * self.b + 1 : self.b, None]])
        all_ = rows[: len(rows) - self.need + 1].copy()
        for k in range(1, self.need):
            all_ &= rows[k : len(rows) - self.need + 1 + k]
        first = all_ & ~np.concatenate([self.found, all_[:-1]])
        self.rows, self.found = rows[len(rows) - self.need + 1 :], all_[-1:]
        where, column = np.nonzero(first)
        at = self.block + (where - (self.need - 1)) * self.b
        self.block += many * self.b
        return at, column + self.lo


class Catchers:
    """The runs of a growing sequence of words, each given as a number. `longest`: words that no run is longer than, if known."""

    def __init__(self, longest: int | None = None):
        self.longest = longest
        self.words, self.n = np.zeros(1 << 10, np.uint64), 0
        self.levels: list[_Level] = []
        #: [start, end, period]; those that the next word may go on, those that blocks still waiting may lie in, all others
        self.open: list[list[int]] = []
        self.near: list[list[int]] = []
        self.done: list[list[int]] = []

    def _agree(self, a: int, b: int, most: int, step: int) -> int:
        """How many words from a and from b on (or back, by step) are the same, at most `most`."""
        got, size = 0, 32
        while got < most:
            size = min(size, most - got)
            if step > 0:
                same = self.words[a + got : a + got + size] == self.words[b + got : b + got + size]
            else:
                same = self.words[a - got - size + 1 : a - got + 1][::-1] == self.words[b - got - size + 1 : b - got + 1][::-1]
            if not same.all():
                return got + int(same.argmin())
            got += size
            size *= 2
        return got

    def _explained(self, at: np.ndarray, period: np.ndarray, size: int) -> np.ndarray:
        """Whether a run of a period that divides this one has the square, which is then a part of that run."""
        runs = np.array(sorted(self.near), np.int64).reshape(-1, 3)
        if not len(runs):
            return np.zeros(len(at), bool)
        far = np.maximum.accumulate(runs[:, 1])
        which = np.maximum.accumulate(np.where(runs[:, 1] == far, np.arange(len(runs)), 0))
        k = np.searchsorted(runs[:, 0], at, "right") - 1
        owner = runs[which[np.maximum(k, 0)]]
        return (k >= 0) & (owner[:, 1] >= at + period + size) & (period % owner[:, 2] == 0)

    def _advance(self, last: bool = False) -> None:
        k = 0
        while k < len(self.levels) or (1 << k <= self.n and (not k or self.longest is None or TIMES * ((4 << k) // 3 + 1) <= self.longest)):
            if k == len(self.levels):
                self.levels.append(_Level(1 << k))
            level = self.levels[k]
            have, can = level.hashed(), self.n - level.b + 1
            if can > have:
                if k == 0:
                    new = self.words[have:can]
                else:
                    half, below = level.b // 2, self.levels[k - 1]
                    one = below.hashes[have - below.at : can - below.at]
                    two = below.hashes[have + half - below.at : can + half - below.at]
                    new = mix(one * np.uint64(0xD6E8FEB86659FD93) + two)
                level.hashes = np.concatenate([level.hashes, new])
            if k:
                self._forget(self.levels[k - 1], level.hashed())
            at, period = level.squares(self.n, last)
            if len(at):
                rest = ~self._explained(at, period, level.need * level.b)
                for i, q in zip(at[rest].tolist(), period[rest].tolist(), strict=True):
                    self._run(i, q)
            k += 1
        if self.levels:
            self._forget(self.levels[-1], self.levels[-1].hashed())
            waits = min(x.block - x.need * x.b for x in self.levels)
            self.done += [r for r in self.near if r[1] <= waits]
            self.near = [r for r in self.near if r[1] > waits]

    @staticmethod
    def _forget(level: _Level, used: int) -> None:
        """used: the words before the first whose hash the next level lacks."""
        keep = min(level.block, used)
        level.hashes, level.at = level.hashes[keep - level.at :].copy(), keep

    def _run(self, i: int, q: int) -> None:
        start = i - self._agree(i - 1, i - 1 + q, i, -1)
        run = [start, i + q + self._agree(i, i + q, self.n - i - q, 1), q]
        self.near.append(run)
        if run[1] == self.n:
            self.open.append(run)

    def append(self, words: np.ndarray) -> None:
        if self.n + len(words) > len(self.words):
            self.words = np.concatenate([self.words[: self.n], np.zeros(max(self.n, len(words)), np.uint64)])
        self.words[self.n : self.n + len(words)] = words
        before, self.n = self.n, self.n + len(words)
        for run in self.open:
            run[1] += self._agree(before - run[2], before, self.n - before, 1)
        self.open = [r for r in self.open if r[1] == self.n]
        self._advance()

    def runs(self) -> list[tuple[int, int, int]]:
        """start, length, period of all runs, by start, then period; no words may follow."""
        self._advance(last=True)
        best: dict[tuple[int, int], int] = {}
        for start, end, q in self.done + self.near:
            best[start, end] = min(q, best.get((start, end), q))
        return sorted((s, e - s, q) for (s, e), q in best.items() if e - s >= max(LEAST, TIMES * q))


def runs_of(words: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    catchers = Catchers(longest)
    for k in range(0, len(words), PIECE):
        catchers.append(words[k : k + PIECE])
    return catchers.runs()


def _numbers(words: list[bytes]) -> np.ndarray:
    """A number for each distinct word."""
    known: dict[bytes, int] = {}
    return mix(np.array([known.setdefault(x, len(known)) for x in words], np.uint64))


def kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words no run has after its first period."""
    keep = np.ones(n, bool)
    for start, length, q in runs:
        keep[start + q : start + length] = False
    return keep


#: Given a doc_id (or None) and the number of words, the numbers of the words to take in their place, or None.
Layout = Callable[[int | None, int], np.ndarray | None]

_FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _chunk(keys: pa.Array, data: np.ndarray, offsets: np.ndarray, layout: Layout | None) -> pa.RecordBatch:
    w = words_of(data, offsets, SPACE)
    count, first = w.count, w.first
    take, moved = np.arange(first[-1]), {}
    if layout:
        for d, (key, n) in enumerate(zip(keys.to_pylist(), count.tolist(), strict=True)):
            order = layout(key, n)
            if order is not None:
                moved[d] = order
                take[first[d] : first[d + 1]] = first[d] + order
    ends = mix(np.arange(len(count), dtype=np.uint64) ^ _SEED)
    stream = np.insert(w.hashes()[take], first[1:], ends)
    begin = first[:-1] + np.arange(len(count))
    by_doc: dict[int, list[tuple[int, int, int]]] = {}
    for start, length, q in runs_of(stream, int(count.max(initial=0))):
        d = int(np.searchsorted(begin, start, "right")) - 1
        by_doc.setdefault(d, []).append((start - int(begin[d]), length, q))
    raw, at = data.tobytes(), offsets.tolist()
    texts, runs = [], []
    for d in range(len(count)):
        words = raw[at[d] : at[d + 1]].split()
        if d in moved:
            words = [words[i] for i in moved[d].tolist()]
        mine = by_doc.get(d, [])
        if any(s + n > len(words) or words[s : s + n - q] != words[s + q : s + n] for s, n, q in mine):
            mine = runs_of(_numbers(words), len(words))
        if mine:
            words = [x for x, k in zip(words, kept(len(words), mine).tolist(), strict=True) if k]
        texts.append(b" ".join(words))
        runs.append(mine)
    flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
    bounds = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
    lists = pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(_RUN)))
    return pa.RecordBatch.from_arrays([keys, pa.array(count), lists, pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", layout: Layout | None = None) -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length and period in words, by start, then period), and collapsed: the
    words that no run has after its first period, joined by one space. Nothing is shuffled."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column(1)):
                yield _chunk(batch.column(0)[a:b], data, offsets, layout)

    rows = docs.select(docs[id_col].cast("long").alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_text"))
    return rows.mapInArrow(run, _FOUND)


def digests(found: DataFrame) -> DataFrame:
    """What `periodic_runs` gives, as counts, the run of the greatest exponent (then the smallest start and period) and digests."""

    def order(a, b):
        mine, other = a["length"] * b["period"], b["length"] * a["period"]
        return F.when((mine > other) | ((mine == other) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"])))), -1).otherwise(1)

    top = F.get(F.array_sort("runs", order), 0)
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", "top.start", "top.length", "top.period", F.expr("top.length * 1000 div top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
