"""A word-end BPE vocabulary over many texts at once: pre-tokens and merges as numpy arrays, the library for the rest.

The pre-tokenizer never lets a token hold white space, so a text's ids are those of its words (split at ASCII white
space), one after another. Words of ASCII and of the letters U+00C0 to U+00FF, in which lower case, normal form and
classes of letters are beyond doubt, are cut into pre-tokens here; each distinct pre-token is merged once while it is
remembered. Any other word (apostrophes, other scripts, control characters, special tokens) goes through the library's
whole chain, once while it is remembered. What is remembered is found by its bytes, never by a hash alone.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

from tidemark.llm.words import SPACE

#: Bytes of the longest pre-token that is merged here.
LONGEST = 16
#: Pre-tokens and words that a Python worker remembers; beyond it starts anew.
REMEMBERED = 300_000
#: UTF-8 bytes of the texts that are encoded together.
CHUNK = 1 << 20
#: Pre-tokens that are merged together.
TOGETHER = 20_000

_LETTER, _DIGIT, _OTHER = 1, 2, 3
KIND = np.full(256, _OTHER, np.uint8)
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = _LETTER
KIND[0x30:0x3A] = _DIGIT
#: Bytes that send a word to the library: controls, the apostrophe, and all of other scripts but what C3 leads.
_ODD = np.zeros(256, bool)
_ODD[:0x20] = _ODD[0x27] = _ODD[0x7F] = True
_ODD[0xC0:] = True
_ODD[0xC3] = False
_ODD[SPACE] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_NONE = np.int32(2**31 - 1)


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte: itself, or the next free one from 256."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a number; data ends with eight more."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


class Remembered:
    """Ids of pieces of bytes, found by the bytes; a piece's entry is its number."""

    def __init__(self, most: int):
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.n_ids = np.zeros(1 << 16, np.int32), 0
        self.first, self.count, self.entries = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32), 0

    def full(self) -> bool:
        return self.entries > self.most

    def add(self, keys: list[bytes], ids: np.ndarray, count: np.ndarray) -> None:
        """Remembers new pieces, given all their ids, one after another, and how many each has."""
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.entries + len(count) > len(self.first):
            self.first, self.count = np.concatenate([self.first, np.zeros_like(self.first)]), np.concatenate([self.count, np.zeros_like(self.count)])
        at, to = self.entries, self.entries + len(count)
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.first[at:to] = self.n_ids + np.cumsum(count) - count
        self.count[at:to] = count
        self.n_ids, self.entries = self.n_ids + len(ids), to
        self.known.update(zip(keys, range(at, to), strict=True))

    def new(self, keys: list[bytes]) -> list[bytes]:
        return list({*keys}.difference(self.known))

    def entries_of(self, keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))

    def gathered(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of entries, one after another, and where each entry's begin, and the end."""
        count = self.count[entry].astype(np.int64)
        to = np.cumsum(count)
        ids = self.ids[np.repeat(self.first[entry] - (to - count), count) + np.arange(to[-1] if len(to) else 0)]
        return ids, np.append(0, to)


def distinct(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct pieces data[start:start + length], of at most LONGEST bytes and none zero, and which one each is; data has LONGEST bytes more.

    Some may be given twice, if hashes of different ones agree.
    """
    eight = _eight(data)
    low = eight[start] & _MASK[np.minimum(length, 8)]
    high = eight[start + 8] & _MASK[np.clip(length - 8, 0, 8)]
    _, one, which = np.unique(low ^ high * np.uint64(0x9E3779B97F4A7C15), return_index=True, return_inverse=True)
    differ = np.flatnonzero((low != low[one][which]) | (high != high[one][which]))
    if len(differ):  # equal mixes of other bytes: each of these stands for itself
        which[differ] = len(one) + np.arange(len(differ))
        one = np.concatenate([one, differ])
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(start[one].tolist(), (start + length)[one].tolist(), strict=True)], which


class Bounds:
    """Where the words of some texts (split at ASCII white space) begin and end, and which have bytes that the short way leaves to a library."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        self.space = SPACE[data]
        #: Where texts begin that aren't empty.
        self.head = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins, ends = ~self.space, ~self.space
        begins[1:] &= self.space[:-1]
        begins[self.head] = ~self.space[self.head]
        ends[:-1] &= self.space[1:]
        ends[self.head[1:] - 1] = ~self.space[self.head[1:] - 1]
        self.begins, self.start, self.end = begins, np.flatnonzero(begins), np.flatnonzero(ends) + 1
        lead, rest = data == 0xC3, (data & 0xC0) == 0x80
        self.after = np.zeros(n, bool)
        self.after[1:] = lead[:-1]
        self.odd = _ODD[data] | rest & ~self.after | self.after & ((data == 0x97) | (data == 0xB7))

    def word_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, at, "right") - 1

    def odd_words(self) -> np.ndarray:
        out = np.zeros(len(self.start), bool)
        out[self.word_of(np.flatnonzero(self.odd))] = True
        return out


class Merges:
    """The merges of a vocabulary, by pairs of ids."""

    def __init__(self, model: dict):
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = _byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int32)
        self.last = np.array([vocab[x + end] for x in letters], np.int32)
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank = key[order], np.arange(len(key), dtype=np.int32)[order]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, or _NONE; an id below zero has no pair."""
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (a >= 0) & (b >= 0), self.rank[at], _NONE)

    def of(self, raw: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """raw: a row of bytes for each pre-token, `length` of them its own. The ids of all, one after another, and how many each has.

        In each round every row merges its pair of the least rank, the leftmost of equals, until no row has one.
        """
        n, width = raw.shape
        at = np.arange(width)
        ids = np.where(at < length[:, None], self.inner[raw], -1).astype(np.int32)
        rows = np.arange(n)
        ids[rows, length - 1] = self.last[raw[rows, length - 1]]
        rank = np.full((n, width), _NONE, np.int32)
        rank[:, :-1] = self.ranks(ids[:, :-1], ids[:, 1:])
        done, open_ = np.full((n, width), -1, np.int32), rows
        while len(open_):
            k = np.arange(len(open_))
            pos = rank.argmin(axis=1)
            best = rank[k, pos]
            more = best != _NONE
            if not more.all():
                done[open_[~more]] = ids[~more]
                ids, rank, open_, pos, best = ids[more], rank[more], open_[more], pos[more], best[more]
                k = k[: len(open_)]
                if not len(open_):
                    break
            keep = at[None, :-1] <= pos[:, None]
            ids[:, :-1] = np.where(keep, ids[:, :-1], ids[:, 1:])
            rank[:, :-1] = np.where(keep, rank[:, :-1], rank[:, 1:])
            ids[:, -1], rank[:, -1] = -1, _NONE
            ids[k, pos] = self.made[best]
            left, right = np.maximum(pos - 1, 0), np.minimum(pos + 1, width - 1)
            rank[k, pos] = np.where(pos + 1 < width, self.ranks(ids[k, pos], ids[k, right]), _NONE)
            has = pos > 0
            rank[k[has], left[has]] = self.ranks(ids[k, left], ids[k, pos])[has]
        real = done >= 0
        return done[real], real.sum(axis=1)


class WordEncoder:
    """Ids of texts, as the tokenizers library gives them without special tokens."""

    def __init__(self, tokenizer_file: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of an executor share its cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.special = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        with open(tokenizer_file) as f:
            whole = json.load(f)
        normal, before, model = ((whole.get(x) or {}) for x in ("normalizer", "pre_tokenizer", "model"))
        split = [x for x in before.get("pretokenizers", []) if x["type"] == "Split"]
        #: The chain that the short way stands for; any other goes the whole way.
        chain = [x["type"] for x in normal.get("normalizers", [])], [x["type"] for x in before.get("pretokenizers", [])]
        self.short = chain == (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) and split[0]["invert"] and split[0]["behavior"] == "Removed" and split[0]["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
        self.short = self.short and model.get("type") == "BPE" and bool(model.get("end_of_word_suffix")) and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "ignore_merges"))
        self.merges = Merges(model) if self.short else None
        self.pieces, self.words = Remembered(remembered), Remembered(remembered)

    def _of_pieces(self, lower: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each pre-token lower[start:start + length], as `gathered` gives them."""
        keys, which = distinct(lower, start, length)
        fresh = self.pieces.new(keys)
        size = np.fromiter(map(len, fresh), np.int64, len(fresh))
        for low, width in ((0, 4), (4, 8), (8, LONGEST)):
            mine = np.flatnonzero((size > low) & (size <= width))
            for k in range(0, len(mine), TOGETHER):
                part = mine[k : k + TOGETHER]
                own = [fresh[i] for i in part.tolist()]
                rows = np.frombuffer(b"".join([x.ljust(width, b"\0") for x in own]), np.uint8).reshape(-1, width)
                self.pieces.add(own, *self.merges.of(rows, size[part]))
        return self.pieces.entries_of(keys)[which]

    def _of_words(self, keys: list[bytes]) -> np.ndarray:
        """The entry of each word, by the library's whole chain."""
        fresh = self.words.new(keys)
        for k in range(0, len(fresh), TOGETHER):
            part = fresh[k : k + TOGETHER]
            got = [x.ids for x in self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)]
            self.words.add(part, np.fromiter((i for x in got for i in x), np.int32), np.fromiter(map(len, got), np.int32, len(got)))
        return self.words.entries_of(keys)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """data: UTF-8 of the texts, one after another; offsets: where each begins, and the end. The ids, and where each text's begin, and the end."""
        for store in (self.pieces, self.words):
            if store.full():
                store.forget()
        w, n = Bounds(data, offsets), len(data)
        if not len(w.start):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        slow = np.ones(len(w.start), bool)
        start = length = np.zeros(0, np.int64)
        raw = data.tobytes()
        if self.short:
            for x in self.special:
                at = raw.find(x)
                while at >= 0:
                    w.odd[at] = True
                    at = raw.find(x, at + 1)
            slow = w.odd_words()
            lower = np.zeros(n + 16, np.uint8)
            lower[:n] = _LOWER[data]
            lower[:n][w.after & (data < 0x9F)] += 0x20
            kind = KIND[data]
            cut = w.begins.copy()
            cut[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
            cut &= ~w.space
            start = np.flatnonzero(cut)
            of = w.word_of(start)
            length = np.minimum(np.append(start[1:], n), w.end[of]) - start
            slow[of[length > LONGEST]] = True
            fast = ~slow[of]
            start, length = start[fast], length[fast]
        which = np.flatnonzero(slow)
        parts = [(self.words, w.start[which], self._of_words([raw[a:b] for a, b in zip(w.start[which].tolist(), w.end[which].tolist(), strict=True)]))]
        if len(start):
            parts.append((self.pieces, start, self._of_pieces(lower, start, length)))
        return in_place(parts, offsets)


def in_place(parts: list[tuple[Remembered, np.ndarray, np.ndarray]], offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of several stores, each with the places of its entries: their ids in the order of places, and where each text's begin, and the end."""
    parts = [x for x in parts if len(x[1])]
    if not parts:
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    got = [store.gathered(entry) for store, _, entry in parts]
    if len(parts) == 1:
        ids, to = got[0]
        return ids, to[np.searchsorted(parts[0][1], offsets)]
    place = np.concatenate([x[1] for x in parts])
    order = np.argsort(place, kind="stable")
    count = np.concatenate([np.diff(to) for _, to in got])[order]
    base = np.cumsum([0, *(len(ids) for ids, _ in got)])
    first = np.concatenate([to[:-1] + b for (_, to), b in zip(got, base, strict=False)])[order]
    to = np.cumsum(count)
    ids = np.concatenate([ids for ids, _ in got])[np.repeat(first - (to - count), count) + np.arange(to[-1])]
    return ids, np.append(0, to)[np.searchsorted(place[order], offsets)]


@lru_cache(maxsize=2)
def word_encoder(tokenizer_file: str) -> WordEncoder:
    """One for all tasks of a Python worker, so that its words are learned once."""
    return WordEncoder(tokenizer_file)
