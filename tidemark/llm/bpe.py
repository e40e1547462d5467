"""Byte-level BPE by dynamic programming over prefixes.

A BPE encoding is right exactly if each two neighbouring tokens stay as they are when their bytes are encoded alone.
So every prefix of a piece has exactly one last token, found from the last tokens of shorter prefixes. `Prefixes`
stores it for each prefix: appending bytes adds entries and changes none; after an edit, only the entries behind it
are computed anew; the ids are read off backwards.

Cases: a null text is an empty one and has no ids. Text that merges differ on (a lone surrogate can't occur in Spark's
UTF-8 strings) has no special treatment, and special tokens are ordinary text. Repeated rows give repeated rows; a null
doc_id stays null; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import keyed, prepare, unkeyed
from tidemark.llm.word_bpe import KIND, CHUNK, LONGEST, Bounds, Remembered, distinct, in_place
from tidemark.llm.words import chunks

#: What a Python worker remembers: pieces between spaces (twice so many), pre-tokens, pairs of tokens. Each is bounded.
CHUNKS_KEPT, PIECES_KEPT, PAIRS_KEPT = 150_000, 250_000, 300_000
#: Pre-tokens of at most LONGEST bytes, and other words, with their ids.
SHORT_KEPT, LONG_KEPT = 400_000, 50_000
#: Slots for pairs of tokens, as a power of two; short pieces that are encoded together.
PAIR_BITS, TOGETHER = 20, 10_000


class Ranks:
    """Tokens of a rank file ("base64 rank" lines) and the test of neighbours."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self.bytes_of = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.bytes_of[rank] = token
        import ahocorasick

        self.tokens_in = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            self.tokens_in.add_word(token.decode("latin-1"), (len(token), rank))
        self.tokens_in.make_automaton()
        self.longest = max(map(len, self.rank))
        self.known: dict[int, bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """The plain definition: merge the neighbours of the lowest rank until none can be."""
        parts = [data[i : i + 1] for i in range(len(data))]
        rank = self.rank
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [rank[x] for x in parts]

    def stays(self, left: int, right: int) -> bool:
        """Whether these neighbours are the encoding of their own bytes."""
        if len(self.known) > PAIRS_KEPT:
            self.known.clear()
        out = self.known[left << 32 | right] = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return out


class Prefixes:
    """The last token of every prefix of one piece of bytes."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        ranks, last = self.ranks, self.last
        old, known = len(last) - 1, ranks.known.get
        last += [-1] * len(more)
        skip = max(0, old - ranks.longest + 1)  # no token that ends behind `old` begins before
        for at, (size, token) in ranks.tokens_in.iter(self.data[skip:].decode("latin-1")):
            end = skip + at + 1
            if end <= old or last[end] >= 0:
                continue
            start = end - size
            if start:
                ok = known(last[start] << 32 | token)
                if ok is None:
                    ok = ranks.stays(last[start], token)
                if not ok:
                    continue
            last[end] = token

    def replace(self, start: int, stop: int, by: bytes) -> None:
        """Puts `by` in the place of data[start:stop]; entries up to start are kept."""
        tail = by + self.data[stop:]
        self.data, self.last = self.data[:start], self.last[: start + 1]
        self.append(tail)

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of the first `end` bytes, or of all."""
        end = len(self.data) if end is None else end
        out = []
        while end:
            token = self.last[end]
            out.append(token)
            end -= len(self.ranks.bytes_of[token])
        return out[::-1]


class Columns:
    """The last tokens of all prefixes of many short pieces, as `Prefixes` finds them for one: a row for each piece, a column for each length."""

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        children: dict[tuple[int, int], int] = {}
        token_at = [-1] * 256
        for token, rank in ranks.rank.items():
            node = token[0]
            for b in token[1:]:
                node = children.setdefault((node, b), len(children) + 256)
            token_at += [-1] * (node + 1 - len(token_at))
            token_at[node] = rank
        token_at += [-1] * (256 + len(children) - len(token_at))
        #: The tree of tokens: the key of an edge is its upper node and its byte.
        key = np.array([node << 8 | b for node, b in children], np.int64)
        order = np.argsort(key)
        self.key, self.child = key[order], np.fromiter(children.values(), np.int64, len(children))[order]
        self.token_at = np.array(token_at, np.int32)
        self.lengths = np.array([len(x) for x in ranks.bytes_of], np.int64)
        #: Pairs met of late and whether they stay, each in the one slot that its hash gives it.
        self.pair, self.stay = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)

    def stays(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left.astype(np.int64) << 32 | right
        slot = (pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        out = self.stay[slot]
        miss = np.flatnonzero(self.pair[slot] != pair)
        if len(miss):
            new, one, which = np.unique(pair[miss], return_index=True, return_inverse=True)
            known, ask = self.ranks.known, self.ranks.stays
            ok = np.array([ask(x >> 32, x & 0xFFFFFFFF) if (k := known.get(x)) is None else k for x in new.tolist()], bool)
            self.pair[slot[miss][one]], self.stay[slot[miss][one]] = new, ok
            out[miss] = ok[which]
        return out

    def last(self, raw: np.ndarray, length: np.ndarray) -> np.ndarray:
        """raw: a row of bytes for each piece, `length` of them its own. At [i, e] the last token of the first e bytes of piece i."""
        n, width = raw.shape
        row, start = np.nonzero(np.arange(width) < length[:, None])
        node = raw[row, start].astype(np.int64)
        found = [(row, start, np.ones(len(row), np.int64), self.token_at[node])]
        for size in range(2, width + 1):  # every token from every place, by one more byte at a time
            on = start + size <= length[row]
            row, start, node = row[on], start[on], node[on]
            key = node << 8 | raw[row, start + size - 1]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            on = self.key[at] == key
            row, start, node = row[on], start[on], self.child[at[on]]
            token = self.token_at[node]
            on = token >= 0
            found.append((row[on], start[on], np.full(int(on.sum()), size), token[on]))
        row, start, size, token = (np.concatenate(x) for x in zip(*found, strict=True))
        end = start + size
        order = np.argsort(end, kind="stable")
        bounds = np.searchsorted(end[order], np.arange(1, width + 2))
        out = np.full((n, width + 1), -1, np.int32)
        for e in range(1, width + 1):
            mine = order[bounds[e - 1] : bounds[e]]
            r, s, t = row[mine], start[mine], token[mine]
            ok = s == 0
            ok[~ok] = self.stays(out[r[~ok], s[~ok]], t[~ok])
            out[r[ok], e] = t[ok]
        return out

    def of(self, raw: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after another, and how many each has."""
        last = self.last(raw, length)
        n, width = raw.shape
        back, at, count = np.full((n, width), -1, np.int32), length.copy(), np.zeros(n, np.int64)
        open_ = np.flatnonzero(at > 0)
        while len(open_):
            token = last[open_, at[open_]]
            count[open_] += 1
            back[open_, width - count[open_]] = token
            at[open_] -= self.lengths[token]
            open_ = open_[at[open_] > 0]
        return back[back >= 0], count


class Encoder:
    """Encodes texts: pre-tokens by the pattern, each by its prefixes."""

    def __init__(self, rank_file: str, pattern: str):
        import regex

        self.ranks, self.find = Ranks(rank_file), regex.compile(pattern).findall
        self.pieces: dict[str, list[int]] = {}
        #: Those met of late, and those before them; what is met again moves to the first.
        self.chunks: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}
        self.columns = Columns(self.ranks)
        self.short, self.long = Remembered(SHORT_KEPT), Remembered(LONG_KEPT)
        lengths = np.array([len(x) for x in self.ranks.bytes_of], np.int64)
        self.starts, self.lengths, self.table = np.cumsum(lengths) - lengths, lengths, np.frombuffer(b"".join(self.ranks.bytes_of), np.uint8)

    def piece(self, x: str) -> list[int]:
        data = x.encode()
        token = self.ranks.rank.get(data)
        return [token] if token is not None else Prefixes(self.ranks, data).ids()

    def kept(self, x: str) -> list[int]:
        known = self.pieces.get(x)
        if known is None:
            if len(self.pieces) > PIECES_KEPT:
                self.pieces.clear()
            known = self.pieces[x] = self.piece(x)
        return known

    def plain(self, text: str) -> list[int]:
        found = self.find(text)
        return self.piece(found[0]) if len(found) == 1 else [i for x in found for i in self.kept(x)]

    def _chunk(self, x: str) -> bytes | None:
        inner = x.removeprefix(" ")
        if not inner or inner[0].isspace() or inner[-1].isspace():
            return None
        return np.array(self.plain(x), "<i4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers.

        No pre-token goes on across a single space before other text, so what stands between such spaces is encoded
        once and remembered. A text with other spaces between is taken whole.
        """
        if not text:
            return b""
        head, *rest = text.split(" ")
        parts = [head, *[" " + x for x in rest]]
        if len(self.chunks) > CHUNKS_KEPT:
            self.older, self.chunks = self.chunks, {}
        known, older = self.chunks, self.older
        for x in set(parts).difference(known):
            known[x] = older[x] if x in older else self._chunk(x)
        got = [*map(known.__getitem__, parts)]
        if None in got:
            return np.array(self.plain(text), "<i4").tobytes()
        return b"".join(got)

    def encode_all(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Many texts at once: UTF-8, one after another, and where each begins, and the end. The ids, and where each text's begin, and the end.

        Words of ASCII without apostrophes and of the letters U+00C0 to U+00FF, and white space between, are cut into pre-tokens as arrays; other words,
        with the space before them, are cut by the pattern. Each distinct one is encoded by its prefixes once while it is remembered. A text in
        which other white space touches that of ASCII is cut by the pattern as a whole.
        """
        for store in (self.short, self.long):
            if store.full():
                store.forget()
        w, n = Bounds(data, offsets), len(data)
        raw = data.tobytes()
        text_end = np.zeros(n + 1, bool)
        text_end[offsets[1:]] = True
        # white space: all but its last byte, and that one by itself unless it is a space that goes with the word behind it
        space = np.flatnonzero(w.space)
        first = space[~np.append(False, w.space)[space] | text_end[space]]
        last = space[~np.append(w.space, False)[space + 1] | text_end[space + 1]]
        at_end = text_end[last + 1]
        joins = ~at_end & (data[last] == 0x20)
        run = np.flatnonzero((last > first) | at_end)
        own = np.flatnonzero(~at_end & ~joins)
        starts = [first[run], last[own]]
        ends = [np.where(at_end[run], last[run] + 1, last[run]), last[own] + 1]
        before = np.zeros(n + 1, bool)  # whether a space goes with the word that begins here
        before[last[joins] + 1] = True
        slow = w.odd_words()
        whole = self._touching(raw, w, np.flatnonzero(slow), offsets)
        kind = KIND[data]
        cut = w.begins.copy()
        cut[1:] |= kind[1:] != kind[:-1]
        cut &= ~w.space
        piece = np.flatnonzero(cut)
        of = w.word_of(piece)
        end = np.minimum(np.append(piece[1:], n), w.end[of])
        fast = ~slow[of]
        starts.append(piece[fast] - (before[piece[fast]] & w.begins[piece[fast]]))
        ends.append(end[fast])
        which = np.flatnonzero(slow)
        start, stop = np.concatenate(starts), np.concatenate(ends)
        long_ = stop - start > LONGEST
        slow_start, slow_stop = np.concatenate([w.start[which] - before[w.start[which]], start[long_]]), np.concatenate([w.end[which], stop[long_]])
        start, stop = start[~long_], stop[~long_]
        if len(whole):
            keep = lambda x: ~np.isin(np.searchsorted(offsets, x, "right") - 1, whole)
            a, b = keep(start), keep(slow_start)
            start, stop, slow_start, slow_stop = start[a], stop[a], np.append(slow_start[b], offsets[whole]), np.append(slow_stop[b], offsets[whole + 1])
        units = [raw[a:b] for a, b in zip(slow_start.tolist(), slow_stop.tolist(), strict=True)]
        parts = [(self.long, slow_start, self._of_units(units))]
        if len(start):
            padded = np.concatenate([data, np.zeros(LONGEST, np.uint8)])
            keys, which = distinct(padded, start, stop - start)
            parts.append((self.short, start, self._of_pieces(keys)[which]))
        order = [np.argsort(x[1], kind="stable") for x in parts]
        return in_place([(store, place[o], entry[o]) for (store, place, entry), o in zip(parts, order, strict=True)], offsets)

    def _of_units(self, keys: list[bytes]) -> np.ndarray:
        fresh = self.long.new(keys)
        got = [self.plain(x.decode()) for x in fresh]
        count = np.fromiter(map(len, got), np.int32, len(got))
        self.long.add(fresh, np.fromiter((i for x in got for i in x), np.int32, int(count.sum())), count)
        return self.long.entries_of(keys)

    def _of_pieces(self, keys: list[bytes]) -> np.ndarray:
        fresh = self.short.new(keys)
        size = np.fromiter(map(len, fresh), np.int64, len(fresh))
        for low, width in ((0, 4), (4, 8), (8, LONGEST)):
            mine = np.flatnonzero((size > low) & (size <= width))
            for k in range(0, len(mine), TOGETHER):
                part = mine[k : k + TOGETHER]
                own = [fresh[i] for i in part.tolist()]
                rows = np.frombuffer(b"".join([x.ljust(width, b"\0") for x in own]), np.uint8).reshape(-1, width)
                self.short.add(own, *self.columns.of(rows, size[part]))
        return self.short.entries_of(keys)

    @staticmethod
    def _touching(raw: bytes, w: Bounds, words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts with a word that begins or ends with white space of another kind."""
        out = set()
        for a, b in zip(w.start[words].tolist(), w.end[words].tolist(), strict=True):
            x = raw[a:b].decode()
            if x[0].isspace() or x[-1].isspace():
                out.add(int(np.searchsorted(offsets, a, "right")) - 1)
        return np.array(sorted(out), np.int64)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, one after another, and where each id's begin, and the end."""
        sizes = self.lengths[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.table[np.repeat(self.starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])], ends


@lru_cache(maxsize=2)
def encoder(rank_file: str, pattern: str) -> Encoder:
    """One for all tasks of a Python worker, so that its words are learned once."""
    return Encoder(rank_file, pattern)


def _run(batches: Iterable[pa.RecordBatch], rank_file: str, pattern: str) -> Iterator[pa.RecordBatch]:
    own = encoder(rank_file, pattern)
    for batch in batches:
        for a, b, data, offsets in chunks(batch.column(1), CHUNK):
            flat, bounds = own.encode_all(data, offsets)
            raw, ends = own.decode(flat)
            where = pa.py_buffer(ends[bounds].astype(np.int32))
            decoded = pa.Array.from_buffers(pa.binary(), b - a, [None, where, pa.py_buffer(raw)])
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], lists, decoded], ["_id", "ids", "decoded"])


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int), decoded (the bytes that the ids stand for). No shuffle: each text alone."""
    prepare(docs.sparkSession)
    out = keyed(docs, id_col, text_col).mapInArrow(partial(_run, rank_file=rank_file, pattern=pattern), "_id long, ids array<int>, decoded binary")
    return out.select(unkeyed().alias("doc_id"), "ids", "decoded")


def with_token_columns(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """encode_documents with the columns n_tokens, ids_sha256 and decoded_sha256 derived from its output."""
    out = encode_documents(docs, rank_file, pattern, id_col, text_col)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
