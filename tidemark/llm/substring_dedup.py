"""Duplicate passages by relative Lempel-Ziv parsing against the corpus itself.

Every document is cut into reference blocks, the runs of neighbouring windows (of `min_words` words) that share a
minimizer: the least hash of the short word runs inside a window. Blocks go to the index part that their minimizer
names, so equal windows meet in one part, whichever documents hold them. A part points each of its windows at the first
document that holds it. A document is then parsed greedily: a factor starts where a window has such a pointer, and goes
on while the next window points at the next word of the same reference; where it stops, the windows across the boundary
have been looked up like all others, and start a factor of their own. Factors have min_words words at least; together
they are the duplicate spans.

What a task finds twice among its own documents it settles itself and sends once, so a passage of thousands of copies
adds one window a task to its part. Windows are told apart by a 64-bit hash of theirs inside one part.

Cases: a null or empty text has no words and stays empty. Rows with one doc_id don't count as each other's source; a
null doc_id comes after all others and stays null. A text of fewer than min_words words loses nothing. An empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import keyed, partitions, prepare, unkeyed
from tidemark.llm.words import SPACE, chunks, window_hashes, words_of

MIN_WORDS = 13
#: Words of a run whose hash can be a minimizer.
RUN = 4
#: UTF-8 bytes of documents that a task takes together.
TOGETHER = 12 << 20
_FACTORS = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]))
_OUT = pa.schema([("_id", pa.int64()), ("n_words", pa.int64()), ("kept", pa.string()), ("factors", _FACTORS)])
_OUT_DDL = "_id long, n_words long, kept string, factors array<struct<start:int,length:int,ref_doc:long,ref_start:int>>"
_ROW = pa.schema([("target", pa.int32()), ("found", pa.bool_()), ("data", pa.binary())])
_ROW_DDL = "target int, found boolean, data binary"
#: A pointer run: a document (by uid), first window, windows, and the reference's doc_id and first window.
_POINTER = np.dtype([("uid", "<i8"), ("pos", "<i4"), ("n", "<i4"), ("ref", "<i8"), ("ref_pos", "<i4")])
#: Windows of a block; its length has 16 bits.
LONGEST = 65535
_BLOCK = np.dtype([("doc", "<u4"), ("pos", "<u4"), ("n", "<u2")])


def _pointers(uid: np.ndarray, pos: np.ndarray, ref: np.ndarray, ref_pos: np.ndarray) -> np.ndarray:
    """Runs of pointers that advance together, from pointers in the order of document and place."""
    out = np.zeros(0, _POINTER)
    if len(uid):
        go_on = (uid[1:] == uid[:-1]) & (pos[1:] == pos[:-1] + 1) & (ref[1:] == ref[:-1]) & (ref_pos[1:] == ref_pos[:-1] + 1)
        first = np.flatnonzero(np.concatenate([[True], ~go_on]))
        out = np.empty(len(first), _POINTER)
        out["uid"], out["pos"], out["ref"], out["ref_pos"] = uid[first], pos[first], ref[first], ref_pos[first]
        out["n"] = np.diff(np.append(first, len(uid)))
    return out


def _first_of_each(hashes: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by hash, document and place, and for each of it the place in the order of the first of its hash."""
    order = np.lexsort((pos, doc, hashes))
    ordered = hashes[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    return order, np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))


def _by_target(target: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
    """(target, first, after the last) of sorted targets."""
    edges = np.searchsorted(target, np.arange(n + 1))
    for t in np.flatnonzero(np.diff(edges)):
        yield int(t), int(edges[t]), int(edges[t + 1])


def _answers(runs: np.ndarray, targets: int) -> Iterator[pa.RecordBatch]:
    target = (runs["uid"].view(np.uint64) % np.uint64(targets)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    runs, target = runs[order], target[order]
    rows = [(t, runs[a:b].tobytes()) for t, a, b in _by_target(target, targets)]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.int32()), pa.array([True] * len(rows)), pa.array([x for _, x in rows], pa.binary())], schema=_ROW)


def _pack(doc_ids: np.ndarray, uids: np.ndarray, doc: np.ndarray, pos: np.ndarray, hashes: np.ndarray) -> bytes:
    """Blocks of one index part: documents, runs of windows, hashes."""
    used, doc = np.unique(doc, return_inverse=True)
    go_on = (doc[1:] == doc[:-1]) & (pos[1:] == pos[:-1] + 1) & (np.arange(1, len(doc)) % LONGEST != 0)
    first = np.flatnonzero(np.concatenate([[True], ~go_on]))
    n = np.diff(np.append(first, len(doc)))
    blocks = np.empty(len(first), _BLOCK)
    blocks["doc"], blocks["pos"], blocks["n"] = doc[first], pos[first], n
    return b"".join([np.array([len(used), len(first)], "<u8").tobytes(), doc_ids[used].tobytes(), uids[used].tobytes(), blocks.tobytes(), hashes.tobytes()])


def _unpack(data: bytes) -> tuple[np.ndarray, ...]:
    docs, runs = np.frombuffer(data, "<u8", 2).tolist()
    at = 16
    doc_ids, uids = np.frombuffer(data, "<i8", docs, at), np.frombuffer(data, "<i8", docs, at + 8 * docs)
    at += 16 * docs
    blocks = np.frombuffer(data, _BLOCK, runs, at)
    hashes = np.frombuffer(data, "<u8", -1, at + _BLOCK.itemsize * runs)
    n = blocks["n"].astype(np.int64)
    doc = np.repeat(blocks["doc"], n)
    pos = np.repeat(blocks["pos"].astype(np.int64) - (np.cumsum(n) - n), n) + np.arange(len(hashes))
    return hashes, doc_ids[doc], uids[doc], pos


def _windows(text: pa.Array, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of some rows: hash, row, place and minimizer of each window."""
    for row, _, data, offsets in chunks(text):
        words = words_of(data, offsets, SPACE)
        hashes = words.hashes()
        whole = window_hashes(hashes, size)
        if not len(whole):
            continue
        short = window_hashes(hashes, min(RUN, size))
        least = short[: len(whole)].copy()
        for k in range(1, size - min(RUN, size) + 1):
            np.minimum(least, short[k : k + len(whole)], out=least)
        doc = np.repeat(np.arange(len(words.count)), words.count)[: len(whole)]
        inside = np.arange(len(whole)) + size <= words.first[doc + 1]
        at = np.flatnonzero(inside)
        yield whole[at], doc[at] + row, at - words.first[doc[at]], least[at]


def _index(size: int, parts: int, targets: int):
    def settle(ids: np.ndarray, uids: np.ndarray, hashes: np.ndarray, doc: np.ndarray, pos: np.ndarray, least: np.ndarray) -> Iterator[pa.RecordBatch]:
        order, first = _first_of_each(hashes, ids[doc], pos)
        doc, pos = doc[order], pos[order]
        own = ids[doc] == ids[doc[first]]
        again = np.flatnonzero(~own)
        again = again[np.lexsort((pos[again], doc[again]))]
        yield from _answers(_pointers(uids[doc[again]], pos[again], ids[doc[first[again]]], pos[first[again]]), targets)
        part = (least[order] % np.uint64(parts)).astype(np.int64)
        sent = np.flatnonzero(own)
        sent = sent[np.lexsort((pos[sent], doc[sent], part[sent]))]
        hashes, doc, pos, part = hashes[order][sent], doc[sent], pos[sent], part[sent]
        rows = [(t, _pack(ids, uids, doc[a:b], pos[a:b], hashes[a:b])) for t, a, b in _by_target(part, parts)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.int32()), pa.array([False] * len(rows)), pa.array([x for _, x in rows], pa.binary())], schema=_ROW)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        ids: list[np.ndarray] = []
        uids: list[np.ndarray] = []
        rows = bytes_held = 0
        for batch in batches:
            k = 0
            while k < len(batch):
                part = batch.slice(k, 500)
                k += 500
                for hashes, doc, pos, least in _windows(part.column("_text"), size):
                    held.append((hashes, doc + rows, pos, least))
                ids.append(part.column("_id").to_numpy())
                uids.append(part.column("_uid").to_numpy())
                rows += len(part)
                bytes_held += part.column("_text").nbytes
                if bytes_held > TOGETHER and held:
                    yield from settle(np.concatenate(ids), np.concatenate(uids), *(np.concatenate(x) for x in zip(*held, strict=True)))
                    held, ids, uids, rows, bytes_held = [], [], [], 0, 0
        if held:
            yield from settle(np.concatenate(ids), np.concatenate(uids), *(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _lookup(targets: int):
    def part(blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        hashes, doc, uid, pos = (np.concatenate(x) for x in zip(*map(_unpack, blocks), strict=True))
        order, first = _first_of_each(hashes, doc, pos)
        doc, uid, pos = doc[order], uid[order], pos[order]
        again = np.flatnonzero(doc != doc[first])
        again = again[np.lexsort((pos[again], uid[again]))]
        yield from _answers(_pointers(uid[again], pos[again], doc[first[again]], pos[first[again]]), targets)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by index part."""
        at, blocks = None, []
        for batch in batches:
            for target, found, data in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if target != at and blocks:
                    yield from part(blocks)
                    blocks = []
                at = target
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([target], pa.int32()), pa.array([True]), pa.array([data], pa.binary())], schema=_ROW)
                else:
                    blocks.append(data)
        if blocks:
            yield from part(blocks)

    return run


def factors_of(runs: np.ndarray, size: int) -> np.ndarray:
    """The greedy parse: runs of one document's windows, joined where one goes on in the same reference.

    Where runs tell of one window twice, as those of repeated rows do, the first by reference holds."""
    runs = runs[np.lexsort((runs["ref_pos"], runs["ref"], runs["pos"]))]
    n = runs["n"].astype(np.int64)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    pos, one = np.unique(np.repeat(runs["pos"], n) + step, return_index=True)
    of = np.repeat(np.arange(len(runs)), n)[one]
    ref, ref_pos = runs["ref"][of], runs["ref_pos"][of] + step[one]
    go_on = (pos[1:] == pos[:-1] + 1) & (ref[1:] == ref[:-1]) & (ref_pos[1:] == ref_pos[:-1] + 1)
    first = np.flatnonzero(np.concatenate([[True], ~go_on]))
    out = runs[of[first]].copy()
    out["pos"], out["ref_pos"] = pos[first], ref_pos[first]
    out["n"] = np.diff(np.append(first, len(pos))) + size - 1
    return out


def _parse(size: int):
    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, _POINTER) for x in answers.column("data").to_pylist()]
        runs = np.concatenate(parts) if parts else np.zeros(0, _POINTER)
        runs = runs[np.argsort(runs["uid"], kind="stable")]
        out = []
        ids, texts = docs.column("_id").to_pylist(), docs.column("_text")
        uids = docs.column("_uid").to_numpy()
        left, right = np.searchsorted(runs["uid"], uids, "left"), np.searchsorted(runs["uid"], uids, "right")
        for i in range(len(ids)):
            words, factors = texts[i].as_py().encode().split(), []
            n_words = len(words)
            if left[i] < right[i]:
                gone = np.zeros(n_words, bool)
                for _, start, n, ref, ref_start in factors_of(runs[left[i] : right[i]], size).tolist():
                    gone[start : start + n] = True
                    factors.append({"start": start, "length": n, "ref_doc": ref, "ref_start": ref_start})
                words = [words[k] for k in np.flatnonzero(~gone).tolist()]
            out.append((ids[i], n_words, b" ".join(words).decode(), factors))
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT) if out else _OUT.empty_table()

    return run


def dedup_substrings(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, kept (the words left, joined by single spaces), factors (start, length, ref_doc, ref_start, in words)."""
    spark = docs.sparkSession
    prepare(spark)
    parts = 2 * partitions(spark)
    rows = keyed(docs, id_col, text_col).withColumn("_uid", F.xxhash64("_id", "_text"))
    indexed = rows.mapInArrow(_index(min_words, parts, parts), _ROW_DDL)
    # an answer that a task has found by itself goes along, to the index part that its target's number names
    found = indexed.repartition("target").sortWithinPartitions("target").mapInArrow(_lookup(parts), _ROW_DDL)
    target = F.pmod(F.col("_uid"), F.lit(parts)) if parts & (parts - 1) == 0 else None
    if target is None:  # the remainder of the unsigned uid, from its halves, each below 2^63
        high, low = F.shiftrightunsigned("_uid", 1), F.col("_uid").bitwiseAND(F.lit(1))
        target = F.pmod(F.pmod(high, F.lit(parts)) * 2 + low, F.lit(parts))
    joined = rows.withColumn("target", target.cast("int")).groupBy("target").cogroup(found.groupBy("target")).applyInArrow(_parse(min_words), _OUT_DDL)
    return joined.select(unkeyed().alias("doc_id"), "n_words", "kept", "factors")


def without_repeats(docs: DataFrame, **more) -> DataFrame:
    """dedup_substrings with its counts and digest."""
    out = dedup_substrings(docs, **more)
    n_kept = F.when(F.col("kept") == "", F.lit(0)).otherwise(F.size(F.split("kept", " "))).cast("long")
    return out.select("doc_id", "n_words", (F.col("n_words") - n_kept).alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"), F.size("factors").alias("n_factors"))
