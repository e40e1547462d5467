"""Token ids as binary shards: one concatenated id array and Elias-Fano coded document boundaries.

A shard is one binary value of a Parquet table in the shared folder, so that any store that Spark writes can hold it:

    magic 8 bytes | u8 bytes of an id | 7 bytes zero | u64 documents | u64 ids | i64 first document id
    | boundaries (Elias-Fano) | document ids less the first (Elias-Fano) | ids, little-endian

An Elias-Fano sequence of n values up to u keeps floor(log2(u / n)) low bits of each, and the rest in unary in a bit
vector of n + (u >> low) bits: under 2 + log2(u / n) bits a value, where a 64-bit table takes 64. The position of
every 64th one of the vector is stored, so that `select` counts bits in one short stretch.

Cases: a null text is an empty document, which has the end id only. A null doc_id comes after all others. Rows with one
doc_id are ordered by text. An empty table gives no shard and no row. Other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import keyed, prepare, shared_dir, unkeyed
from tidemark.llm.word_bpe import CHUNK, word_encoder
from tidemark.llm.words import chunks

MAGIC = b"TIDEIDS1"
_HEAD = struct.Struct("<8sB7xQQq")
_SEQ = struct.Struct("<QQBxxxxxxx")
_EVERY = 64
#: Ids in a shard, unless one document has more.
SHARD_IDS = 1 << 20


class EliasFano:
    """A sequence of ascending non-negative integers."""

    def __init__(self, n: int, top: int, low: int, lows: np.ndarray, highs: np.ndarray, samples: np.ndarray):
        self.n, self.top, self.low, self.lows, self.highs, self.samples = n, top, low, lows, highs, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low = max(0, (top // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1) if low else np.zeros((n, 0))
        lows = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        high = np.zeros(n + (top >> low) + 1, np.uint8)
        high[ones] = 1
        return cls(n, top, low, lows, np.packbits(high, bitorder="little"), ones[::_EVERY].astype(np.uint64))

    def select(self, i: int) -> int:
        """The position of one number i of the bit vector."""
        at = int(self.samples[i // _EVERY])
        left = i % _EVERY
        if not left:
            return at
        byte, width = (at + 1) // 8, 8
        piece = int.from_bytes(self.highs[byte : byte + width].tobytes(), "little") >> (at + 1) % 8 << (at + 1) % 8
        while left > (k := piece.bit_count()):
            left, byte = left - k, byte + width
            piece = int.from_bytes(self.highs[byte : byte + width].tobytes(), "little")
        for _ in range(left - 1):
            piece &= piece - 1
        return byte * 8 + (piece & -piece).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        high = self.select(i) - i
        if not self.low:
            return high
        at = i * self.low
        piece = int.from_bytes(self.lows[at >> 3 : (at + self.low + 7) >> 3].tobytes(), "little")
        return high << self.low | piece >> (at & 7) & (1 << self.low) - 1

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)
        if self.low:
            bits = np.unpackbits(self.lows, bitorder="little")[: self.n * self.low].reshape(self.n, self.low)
            out |= (bits.astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return out

    def tobytes(self) -> bytes:
        return b"".join([_SEQ.pack(self.n, self.top, self.low), self.lows.tobytes(), self.highs.tobytes(), self.samples.tobytes()])

    @classmethod
    def read(cls, raw: memoryview, at: int) -> tuple[EliasFano, int]:
        n, top, low = _SEQ.unpack_from(raw, at)
        at += _SEQ.size
        sizes = (n * low + 7) // 8, (n + (top >> low) + 1 + 7) // 8, -(-n // _EVERY) * 8
        parts = []
        for size, kind in zip(sizes, (np.uint8, np.uint8, np.uint64), strict=True):
            parts.append(np.frombuffer(raw[at : at + size], kind))
            at += size
        return cls(n, top, low, *parts), at


def pack(doc_ids: list[int], bodies: list[bytes], width: int) -> bytes:
    """bodies: the ids of each document, little-endian, `width` bytes each. doc_ids ascend."""
    ends = np.cumsum([0, *(len(x) // width for x in bodies)])
    first = doc_ids[0] if doc_ids else 0
    gaps = np.array([x - first for x in doc_ids], np.uint64)
    return b"".join([_HEAD.pack(MAGIC, width, len(doc_ids), int(ends[-1]), first), EliasFano.of(ends).tobytes(), EliasFano.of(gaps).tobytes(), *bodies])


class Shard:
    """A shard that was read; `ids(i)` finds one document by two selects, without a table of offsets."""

    def __init__(self, raw: bytes):
        view = memoryview(raw)
        magic, self.width, self.docs, self.n_ids, self.first = _HEAD.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self.ends, at = EliasFano.read(view, _HEAD.size)
        self.gaps, at = EliasFano.read(view, at)
        self.body = np.frombuffer(view[at:], "<u2" if self.width == 2 else "<u4")
        if len(self.body) != self.n_ids:
            raise ValueError("a token shard is cut short")

    def doc_id(self, i: int) -> int:
        return self.first + self.gaps[i]

    def ids(self, i: int) -> np.ndarray:
        return self.body[self.ends[i] : self.ends[i + 1]]


class WordCache:
    """The ids of texts as bytes, `width` of them an id; words met before are remembered."""

    def __init__(self, tokenizer_file: str, width: int):
        self.encoder, self.width = word_encoder(tokenizer_file), width

    def bodies(self, texts: list[str] | pa.Array) -> list[bytes]:
        out = []
        for _, _, data, offsets in chunks(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()), CHUNK):
            ids, bounds = self.encoder.encode(data, offsets)
            raw, at = ids.astype(f"<u{self.width}").tobytes(), (bounds * self.width).tolist()
            out += [raw[x:y] for x, y in zip(at, at[1:], strict=False)]
        return out


def _encoded(tokenizer_file: str, end_id: int, width: int, shard_ids: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part, seq = WordCache(tokenizer_file, width), TaskContext.get().partitionId(), 0
        end = end_id.to_bytes(width, "little")
        ids: list[int] = []
        bodies: list[bytes] = []
        held = within = 0

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "docs": [len(ids)], "within": [within], "n_ids": [held // width], "data": [pack(ids, bodies, width)]}, schema=_SHARD_ARROW)

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for k in range(0, len(keys), 500):
                for key, body in zip(keys[k : k + 500], cache.bodies(texts[k : k + 500]), strict=True):
                    if ids and held + len(body) > shard_ids * width:
                        yield shard()
                        within += held // width
                        ids, bodies, held, seq = [], [], 0, seq + 1
                    ids.append(key)
                    bodies.append(body + end)
                    held += len(body) + width
        if ids:
            yield shard()

    return run


_SHARD_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("docs", pa.int64()), ("within", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())])
_SHARD = "part int, seq int, docs long, within long, n_ids long, data binary"


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, vocabulary: int = 49408, shard_ids: int = SHARD_IDS) -> None:
    """Encodes every text, appends end_id to each, and writes shards in ascending id order to a new table at `path`.

    The texts are dealt out by ranges of the id (and by how they begin, as many may have no id) and sorted there, so shard (part, seq) holds one run of ids, and the
    order of shards is the order of documents. A shard is as long as shard_ids or as one document.
    """
    prepare(docs.sparkSession)
    width = 2 if max(vocabulary - 1, end_id) < 2**16 else 4
    ordered = keyed(docs, id_col, text_col).repartitionByRange("_id", F.substring("_text", 1, 64)).sortWithinPartitions("_id", "_text")
    ordered.mapInArrow(_encoded(tokenizer_file, end_id, width, shard_ids), _SHARD).write.parquet(path)


def shards_with_start(spark: SparkSession, path: str) -> DataFrame:
    """The shards with `start`: ids of all shards before each.

    A shard knows the ids before it in its part; the sums of whole parts, one number for each partition that was
    written, meet on the driver and are broadcast (16 bytes a part).
    """
    shards = spark.read.schema(_SHARD).parquet(path)
    before, total = [], 0
    for part, n in sorted(shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()):
        before.append((part, total))
        total += n
    starts = spark.createDataFrame(before, "part int, before long")
    return shards.join(F.broadcast(starts), "part").withColumn("start", F.col("before") + F.col("within"))


def _decoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, data in zip(batch.column("start").to_pylist(), batch.column("data"), strict=True):
            shard = Shard(data.as_py())
            ids = range(shard.docs)
            bodies = [*map(shard.ids, ids)]
            n_tokens = [*map(len, bodies)]
            yield pa.RecordBatch.from_pydict(
                {
                    "_id": [*map(shard.doc_id, ids)],
                    "start": [start + shard.ends[i] for i in ids],
                    "n_tokens": n_tokens,
                    "ids_crc32": [zlib.crc32(x.astype("<u4")) for x in bodies],
                },
                schema=_FOUND,
            )


_FOUND = pa.schema([(c, pa.int64()) for c in ("_id", "start", "n_tokens", "ids_crc32")])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """From the shards, per document: doc_id, start, n_tokens, ids_crc32."""
    prepare(spark)
    found = shards_with_start(spark, path).select("start", "data").mapInArrow(_decoded, "_id long, start long, n_tokens long, ids_crc32 long")
    return found.select(unkeyed().alias("doc_id"), "start", "n_tokens", "ids_crc32")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
