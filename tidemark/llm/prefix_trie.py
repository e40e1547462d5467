"""The trie of conversations by their turns: every prefix that some share, with what keeping it once would save.

A prefix is known by the XOR of the digests of its turns, each with its place: two 64-bit hashes, so prefixes are told
apart by 128 bits. The XOR of a long conversation is made in stretches of 1,024 turns, so no conversation is whole in
one task.

A count-min sketch of all prefix digests screens them: two rows of counters that stop at two, filled by each task for
what it reads, packed, added by blocks, and broadcast (at most 2 x 2^24 counters of 2 bits, 8 MB; 64 KB at least). A
counter is never too low, so an estimate of one proves that a prefix is one conversation's alone. All that follows such
a prefix is then that conversation's too: tails are given out as rows where they are, and only prefixes that may be
shared are shuffled, to be grouped exactly. Where the sketch is full it proves less, and more is grouped; the result
is the same.

Sums over subtrees need no walk: each node belongs to its smallest member, and the nodes of one owner are a path
downwards. So a node's sum is that of the rest of its owner's path, and the sums of whole paths of those members that
own nodes only further down. Both are one grouping of (conversation, prefix) rows.

Cases: rows without a conv_id belong to no conversation. A null turn comes first, equal turns are ordered by role, then
text; a null role or text is empty. Repeated rows are turns of their own. A conversation without turns ends at the root. An
empty table has no conversations and gives no row, not even the root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import cut, prepare

#: Rows of a key that are numbered or summed together: a power of two.
STRETCH_BITS = 10
#: Counters of a row of the sketch: four for each prefix, within these powers of two.
LEAST_BITS, MOST_BITS = 16, 24
#: Counters in a block of the sketch, at most.
BLOCK = 1 << 16
#: Characters of ids that are joined before they meet those of other tasks.
PIECE = 1 << 16


def _before(rows: DataFrame, key: str, stretch: str, **sums: Column) -> DataFrame:
    """key, stretch, and sums over all earlier stretches of the key; stretches that have none are left out."""
    w = Window.partitionBy(key).orderBy(stretch).rowsBetween(Window.unboundedPreceding, -1)  # a row for each stretch
    whole = rows.groupBy(key, stretch).agg(*[c.alias(n) for n, c in sums.items()])
    run = {n: F.bit_xor(n).over(w) if n.startswith("x") else F.sum(n).over(w) for n in sums}
    return whole.select(key, stretch, *[c.alias(f"{n}_before") for n, c in run.items()]).where(f"{next(iter(sums))}_before is not null")


def numbered(rows: DataFrame, key: str, order: list[str], keep: list[Column]) -> DataFrame:
    """key, at and the columns of `keep`: at numbers the rows of a key from 0 in the order of `order`.

    Rows are sorted by ranges of key and order, so a key with many rows is dealt to many tasks; rows are numbered in
    stretches, and stretches by the sum of those before."""
    s = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    s = cut(s.select(key, *keep, F.monotonically_increasing_id().alias("_id")).withColumn("_stretch", F.shiftright("_id", STRETCH_BITS)))
    before = _before(s, key, "_stretch", n=F.count("*"))
    local = F.row_number().over(Window.partitionBy(key, "_stretch").orderBy("_id")) - 1
    out = s.withColumn("_local", local).join(before, [key, "_stretch"], "left")
    return out.withColumn("at", F.col("_local") + F.coalesce("n_before", F.lit(0))).drop("_id", "_stretch", "_local", "n_before")


def turns_of(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, at (from 0), one and two (digests of role and text), bytes (of the text) of each turn."""
    empty = lambda c: F.coalesce(conversations[c].cast("string"), F.lit(""))
    rows = conversations.where(conversations[id_col].isNotNull()).select(conversations[id_col].cast("long").alias("conv"), conversations[turn_col].alias("turn"), empty(role_col).alias("role"), empty(text_col).alias("text"))
    digest = [F.xxhash64(F.lit(k), "role", "text").alias(n) for k, n in ((1, "one"), (2, "two"))]
    return numbered(rows, "conv", ["turn", "role", "text"], [*digest, F.octet_length("text").cast("long").alias("bytes")])


def sizes_of(turns: DataFrame) -> DataFrame:
    """conv, n_turns of conversations that have turns."""
    return turns.groupBy("conv").agg(F.count("*").alias("n_turns"))


def _prefixes(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """conv, depth, the digest of the prefix (x, y) and of that without its last turn (px, py), bytes and whether the conversation ends there."""
    own = turns.select("conv", "at", "bytes", F.xxhash64("one", "at").alias("x"), F.xxhash64("two", "at").alias("y"), F.shiftright("at", STRETCH_BITS).alias("_stretch"))
    w = Window.partitionBy("conv", "_stretch").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before = _before(own, "conv", "_stretch", x=F.bit_xor("x"), xy=F.bit_xor("y"))
    local = own.withColumn("sx", F.bit_xor("x").over(w)).withColumn("sy", F.bit_xor("y").over(w)).join(before, ["conv", "_stretch"], "left").join(sizes, "conv")
    x, y = (F.col(s).bitwiseXOR(F.coalesce(b, F.lit(0))) for s, b in (("sx", "x_before"), ("sy", "xy_before")))
    return local.select("conv", (F.col("at") + 1).alias("depth"), x.alias("x"), y.alias("y"), x.bitwiseXOR(F.col("x")).alias("px"), y.bitwiseXOR(F.col("y")).alias("py"), "bytes", (F.col("at") + 1 == F.col("n_turns")).alias("last"))


def _pack(counts: np.ndarray) -> bytes:
    four = counts.reshape(-1, 4)
    return zlib.compress((four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).tobytes(), 1)


def _unpack(raw: bytes) -> np.ndarray:
    b = np.frombuffer(zlib.decompress(raw), np.uint8)
    return np.stack([b & 3, b >> 2 & 3, b >> 4 & 3, b >> 6], axis=1).ravel()


_BLOCKS = "block int, counts binary"


def _counted(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << bits), np.uint8)
        for batch in batches:
            for row, column in zip(counts, batch.columns, strict=True):
                cell, n = np.unique(column.to_numpy().view(np.uint64) & np.uint64((1 << bits) - 1), return_counts=True)
                row[cell] = np.minimum(row[cell] + np.minimum(n, 2), 2)
        for k, part in enumerate(counts.reshape(-1, min(BLOCK, 1 << bits))):
            if part.any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "counts": pa.array([_pack(part)], pa.binary())})

    return run


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order, those of one number added; only one is held."""
    block, counts = -1, np.zeros(0, np.uint8)
    out = lambda: pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "counts": pa.array([_pack(counts)], pa.binary())})
    for batch in batches:
        for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k == block:
                counts = np.minimum(counts + _unpack(raw), 2)
                continue
            if block >= 0:
                yield out()
            block, counts = k, _unpack(raw)
    if block >= 0:
        yield out()


def sketch(prefixes: DataFrame, bits: int) -> np.ndarray:
    """A count-min sketch of the digests (x, y): two rows of 2^bits counters that stop at two, four to a byte."""
    parts = prefixes.select("x", "y").mapInArrow(_counted(bits), _BLOCKS)
    merged = parts.repartition("block").sortWithinPartitions("block").mapInArrow(_added, _BLOCKS)
    out = np.zeros((2 << bits) // 4, np.uint8).reshape(-1, min(BLOCK, 1 << bits) // 4)
    for r in merged.toLocalIterator():
        out[r.block] = np.frombuffer(zlib.decompress(r.counts), np.uint8)
    return out.reshape(2, -1)


def alone(prefixes: DataFrame, bits: int):
    """A function of two columns of digests: whether the sketch proves that only one conversation has the prefix."""
    known = prefixes.sparkSession.sparkContext.broadcast(sketch(prefixes, bits))

    @F.pandas_udf("boolean")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        least = np.full(len(x), 3, np.uint8)
        for row, column in zip(known.value, (x, y), strict=True):
            cell = column.to_numpy(np.int64).view(np.uint64) & np.uint64((1 << bits) - 1)
            least = np.minimum(least, row[cell >> np.uint64(2)] >> ((cell & np.uint64(3)) << np.uint64(1)).astype(np.uint8) & 3)
        return pd.Series(least == 1)

    return run


@dataclass
class Trie:
    """The nodes: `shared`, those that several conversations may have, with the digest (x, y), and `tails`, those that one has.

    Both have conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved; `last` of tails says whether
    the conversation ends there. `ends` has (x, y, conv) of conversations that end at shared nodes.
    """

    shared: DataFrame
    tails: DataFrame
    ends: DataFrame


def trie(turns: DataFrame, sizes: DataFrame, least_bits: int = LEAST_BITS, most_bits: int = MOST_BITS) -> Trie:
    """turns: as `turns_of` gives them. sizes: conv, n_turns of all conversations, those without turns too."""
    prepare(turns.sparkSession)
    prefixes = cut(_prefixes(turns, sizes))
    bits = min(max((4 * prefixes.count()).bit_length(), least_bits), most_bits)
    proven = alone(prefixes, bits)
    rows = cut(prefixes.withColumn("single", proven("x", "y")).withColumn("below", (F.col("depth") > 1) & proven("px", "py")))
    none = F.lit(None).cast("long")
    roots = sizes.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), none.alias("px"), none.alias("py"), F.lit(0).cast("long").alias("bytes"), (F.col("n_turns") == 0).alias("last"))
    maybe = rows.where("not single").select(*roots.columns).unionByName(roots)
    single = rows.where("single")
    tops = single.where("not below")

    node = ["x", "y", "depth"]
    nodes = cut(maybe.groupBy(*node).agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("px").alias("px"), F.min("py").alias("py"), F.max("bytes").alias("bytes")))
    children = nodes.where("depth > 0").select("px", "py").unionByName(tops.select("px", "py")).groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id"))
    known = nodes.join(children, ["x", "y"], "left").join(parents, ["px", "py"], "left")
    # a parent that isn't among the nodes is a proven tail, of the same conversation
    known = known.withColumn("parent_conv_id", F.coalesce("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id"))))
    known = cut(known.withColumn("n_children", F.coalesce("n_children", F.lit(0))).withColumn("own", (F.col("n_convs") - 1) * F.col("bytes")))

    owned = known.select(F.col("conv_id").alias("conv"), "depth", "own", (F.col("n_children") == 0).cast("long").alias("leaf"))
    ends_alone = single.where("last or not below").select("conv", "depth", F.lit(0).cast("long").alias("own"), F.col("last").cast("long").alias("leaf"))
    paths = cut(owned.unionByName(ends_alone).groupBy("conv").agg(F.min("depth").alias("first"), F.sum("own").alias("path"), F.sum("leaf").alias("leaf")))
    deeper = maybe.join(paths.where("path > 0 or leaf > 0"), "conv").where("depth < first").groupBy(*node).agg(F.sum("path").alias("paths"), F.sum("leaf").alias("leaves"))

    staged = known.withColumn("_stretch", F.shiftright("depth", STRETCH_BITS))
    w = Window.partitionBy("conv_id", "_stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    above = staged.withColumn("above", F.coalesce(F.sum("own").over(w), F.lit(0))).join(_before(staged, "conv_id", "_stretch", n=F.sum("own")), ["conv_id", "_stretch"], "left")
    above = above.withColumn("above", F.col("above") + F.coalesce("n_before", F.lit(0))).join(paths.select(F.col("conv").alias("conv_id"), "path", "leaf"), "conv_id")
    shared = above.join(deeper, node, "left").select(
        *node, "conv_id", "parent_conv_id", "n_convs", "n_children",
        (F.col("leaf") + F.coalesce("leaves", F.lit(0))).alias("n_leaves"), (F.col("path") - F.col("above") + F.coalesce("paths", F.lit(0))).alias("saved"),
    )

    one, end = F.lit(1).cast("long"), F.when(F.col("last"), 0).otherwise(1).cast("long")
    of_tail = lambda df, parent: df.select(F.col("conv").alias("conv_id"), "depth", parent.alias("parent_conv_id"), one.alias("n_convs"), end.alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved"), "last")
    tails = of_tail(tops.join(parents, ["px", "py"]), F.col("parent_conv_id")).unionByName(of_tail(single.where("below"), F.col("conv")))
    return Trie(shared, tails, maybe.where("last").select("x", "y", "depth", "conv"))


def _joined(most: int):
    """Sorted (x, y, conv) to (x, y, first, ids): ids of one node joined by commas, in pieces of some `most` characters."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, size = None, 0, [], 0
        for batch in batches:
            out = []
            for x, y, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (x, y) != key or size > most:
                    if ids:
                        out.append((*key, first, ",".join(ids)))
                    key, first, ids, size = (x, y), conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], schema=_IDS)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, first, ",".join(ids))], schema=_IDS)

    return run


_IDS = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to (x, y, the SHA-256 of all of a node's); one piece is held."""
    key, sha = None, None
    for batch in batches:
        done = []
        for x, y, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (x, y) == key:
                sha.update(b"," + ids.encode())
            else:
                if key:
                    done.append((*key, sha.hexdigest()))
                key, sha = (x, y), hashlib.sha256(ids.encode())
        yield from _hash_rows(done)
    if key:
        yield from _hash_rows([(*key, sha.hexdigest())])


def _hash_rows(rows: list[tuple[int, int, str]]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pydict({"x": [r[0] for r in rows], "y": [r[1] for r in rows], "sha": [r[2] for r in rows]})


def end_digests(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """x, y, sha: of the ids of conversations that end at a node, ascending, joined by commas.

    Ids are sorted by ranges of node and id, so those of a node with many are joined by many tasks; only joined pieces meet."""
    pieces = ends.select("x", "y", "conv").repartitionByRange("x", "y", "conv").sortWithinPartitions("x", "y", "conv").mapInArrow(_joined(piece), "x long, y long, first long, ids string")
    return pieces.repartition("x", "y").sortWithinPartitions("x", "y", "first").mapInArrow(_hashed, "x long, y long, sha string")


def with_digests(t: Trie, piece: int = PIECE) -> DataFrame:
    """All nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    nothing = hashlib.sha256(b"").hexdigest()
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens")]
    shared = t.shared.join(end_digests(t.ends, piece), ["x", "y"], "left").select(*names, F.coalesce("sha", F.lit(nothing)).alias("ends_sha256"))
    return shared.unionByName(t.tails.select(*names, F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(nothing).alias("ends_sha256")))
