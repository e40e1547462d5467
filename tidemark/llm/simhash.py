"""Near-duplicates by SimHash: fingerprints, links of few differing bits found in BK-trees, components.

Fingerprints link if they differ in at most two bits. Cut into four quarters, such two agree in two quarters, so each
distinct fingerprint goes to six shards, one for each pair of quarters and their value, and links are looked for inside
shards. A shard that holds more than SHARD fingerprints is dealt anew by quarters of the other 32 bits, which leaves it
65,536 at most. In each shard a BK-tree is built, whose children are keyed by their distance to the parent; all of
the shard's fingerprints go down it together, along edges within two of their own distance. The trees grow with the
input, so they are not broadcast: the task that gets a shard's fingerprints builds its tree. Of the links of a shard
only a spanning forest leaves it.

Cases: a null or empty text has fingerprint zero, and so has one without words; they link like any other. Copies share
one fingerprint, which is looked up once. A null doc_id stays null and comes last; rows with one doc_id are
judged each by its own text: components are of fingerprints, never of ids. An empty table gives no row; other columns
are kept by `one_of_each` and ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import NO_ID, cut, keyed, prepare, unkeyed

RADIUS, SHINGLE, SEED = 2, 3, 42
#: Fingerprints of a shard beyond which it is dealt anew.
SHARD = 4096
_UPPER = bytes(range(65, 91))
_LOWERED = bytes.maketrans(_UPPER, _UPPER.lower())


def fingerprint(text: str, size: int = SHINGLE, digest=None) -> int:
    """Of one text, as an unsigned integer."""
    if digest is None:
        from xxhash import xxh64_intdigest as digest
    words = text.encode().translate(_LOWERED).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    h = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=False)] or [digest(joined, SEED)]
    bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(h), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh64_intdigest

    for batch in batches:
        prints = np.array([fingerprint(x, digest=xxh64_intdigest) for x in batch.column(1).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64)), batch.column(2)], ["_id", "print", "_h"])


class BKTree:
    """Distinct fingerprints; a node's child under key k is the tree of those at distance k from the node."""

    def __init__(self, prints: np.ndarray, at: np.ndarray | None = None):
        at = np.arange(len(prints)) if at is None else at
        self.at, rest = int(at[0]), at[1:]
        self.print = prints[self.at]
        away = np.bitwise_count(prints[rest] ^ self.print)
        self.children = {int(k): BKTree(prints, rest[away == k]) for k in np.unique(away)}

    def within(self, prints: np.ndarray, radius: int, of: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(node, which of the asked are within the radius of it)."""
        stack = [(self, np.arange(len(prints)) if of is None else of)]
        while stack:
            node, asked = stack.pop()
            away = np.bitwise_count(prints[asked] ^ node.print).astype(np.int64)
            yield node.at, asked[away <= radius]
            for k, child in node.children.items():
                near = asked[np.abs(away - k) <= radius]
                if len(near):
                    stack.append((child, near))


def _forest(prints: np.ndarray, docs: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what the links of these fingerprints join."""
    parent = list(range(len(prints)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for node, near in BKTree(prints).within(prints, RADIUS):
        for x in near.tolist():
            a, b = root(node), root(x)
            if a != b:
                parent[b] = a
                out.append((int(docs[node]), int(docs[x])))
    return out


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard; a shard may go on from batch to batch."""
    held: list[tuple[np.ndarray, ...]] = []

    def done(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        shard, prints, docs = (np.concatenate(x) for x in zip(*parts, strict=True))
        edges = np.flatnonzero(np.diff(shard)) + 1
        found = [x for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(shard)], strict=True) if b - a > 1 for x in _forest(prints[a:b], docs[a:b])]
        if found:
            yield pa.RecordBatch.from_pydict({"a": [x for x, _ in found], "b": [x for _, x in found]})

    for batch in batches:
        shard, prints, docs = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
        if not len(shard):
            continue
        last = int(np.searchsorted(shard, shard[-1], "left"))
        if last:
            yield from done([*held, (shard[:last], prints[:last].view(np.uint64), docs[:last])])
            held = []
        elif held and held[-1][0][-1] != shard[0]:
            yield from done(held)
            held = []
        held.append((shard[last:], prints[last:].view(np.uint64), docs[last:]))
    if held:
        yield from done(held)


_PAIRS = list(combinations(range(4), 2))


def _keys(fields: list[tuple[int, int]], *more) -> Column:
    """A shard key for each two of the fields (shift, width) of the fingerprint; more: what else is in the key."""
    field = lambda x: F.shiftrightunsigned("print", x[0]).bitwiseAND(F.lit((1 << x[1]) - 1))
    return F.array(*[F.xxhash64(*more, F.lit(k), field(a), field(b)) for k, (a, b) in enumerate(combinations(fields, 2))])


def links(prints: DataFrame, shard: int = SHARD) -> DataFrame:
    """a, b: edges that join all nodes (column doc) whose fingerprints (column print, distinct) are within the radius.

    A shard key is a hash; two shards under one key are searched together, which finds the same links.
    """
    dealt = prints.select(F.posexplode(_keys([(16 * q, 16) for q in range(4)])).alias("pair", "shard"), "print", "doc")
    large = dealt.groupBy("shard").count().where(F.col("count") > shard).select("shard", F.lit(True).alias("large"))
    marked = dealt.join(large, "shard", "left")
    others = [[(16 * q + h, 8) for q in range(4) if q not in pair for h in (0, 8)] for pair in _PAIRS]
    again = marked.where("large").select(F.explode(F.element_at(F.array(*[_keys(x, "shard") for x in others]), F.col("pair") + 1)).alias("shard"), "print", "doc")
    small = marked.where("large is null").select("shard", "print", "doc")
    return small.union(again).repartition("shard").sortWithinPartitions("shard").mapInArrow(_links, "a long, b long")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shard: int) -> DataFrame:
    """_id, print, _h (hash of the text), _part (the smallest fingerprint of the component), _root (its smallest _id)."""
    prepare(docs.sparkSession)
    texts = keyed(docs, id_col, text_col).select("_id", "_text", F.xxhash64("_text").alias("_h"))
    of = cut(texts.mapInArrow(_fingerprints, "_id long, print long, _h long"))
    prints = cut(of.groupBy("print").agg(F.min("_id").alias("_id")))
    parts = components(links(prints.select("print", F.col("print").alias("doc")), shard))
    by_print = prints.join(parts, F.col("print") == F.col("node"), "left").select("print", "_id", F.coalesce("root", "print").alias("_part"))
    by_part = by_print.groupBy("_part").agg(F.min("_id").alias("_root"))
    return of.join(by_print.drop("_id").join(by_part, "_part"), "print")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """doc_id, print (the fingerprint, signed), component_id (the smallest doc_id reachable by links)."""
    return _grouped(docs, id_col, text_col, shard).select(unkeyed().alias("doc_id"), "print", unkeyed("_root").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """The row of docs with the smallest id of each component; of several, that with the smallest hash of its text.

    Rows of one id and text are one row, the smallest; they meet in the tasks that read them, and one from each after.
    """
    first = _grouped(docs, id_col, text_col, shard).groupBy("_part").agg(F.min(F.struct("_id", "_h")).alias("_first")).select("_first.*")
    rows = docs.select(F.struct("*").alias("_row"), F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(F.coalesce(docs[text_col], F.lit(""))).alias("_h"))
    return rows.groupBy("_id", "_h").agg(F.min("_row").alias("_row")).join(first, ["_id", "_h"], "left_semi").select("_row.*")


def with_fingerprint(docs: DataFrame, **more) -> DataFrame:
    """near_duplicates with the fingerprint as 16 hexadecimal digits."""
    out = near_duplicates(docs, **more)
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
