"""op11: runs by catchers against all periods tried one by one, however the words come in."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF
from tidemark.llm import periodic_runs
from tidemark.llm.registry import op11_periodic_runs
from tidemark.llm.words import mix


def _runs(words):
    """Every period tried at every place."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


WORDS = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.integers(1, 60)), max_size=6).map(lambda parts: [x for u, n in parts for x in (u * 60)[:n]])


@settings(max_examples=400, deadline=None)
@given(words=WORDS, data=st.data())
def test_catchers(words, data):
    numbers, catchers = mix(np.array(words, np.uint64)), periodic_runs.Catchers(data.draw(st.sampled_from([None, len(words)])))
    at = 0
    while at < len(words):
        n = data.draw(st.integers(1, 40))
        catchers.append(numbers[at : at + n])
        at += n
    assert catchers.runs() == _runs(words) == periodic_runs.runs_of(numbers, len(words))


def test_long_periods():
    rng = np.random.default_rng(4)
    own = rng.integers(0, 1 << 40, 90_000).astype(np.uint64)
    expected = []
    for at, q, times in ((100, 5000, 4), (30_000, 1777, 9), (60_000, 6999, 4)):
        own[at : at + q * times] = np.tile(own[at : at + q], times)
        expected.append((at, q * times, q))
    assert periodic_runs.runs_of(own) == expected
    assert periodic_runs.runs_of(np.zeros(50_000, np.uint64)) == [(0, 50_000, 1)]


def test_memory_goes_with_the_longest_period():
    """Catchers of a stream in which no run is longer than 400 words keep hashes of some thousand words."""
    catchers = periodic_runs.Catchers(400)
    for k in range(30):
        catchers.append(mix(np.arange(k * 1000, k * 1000 + 1000, dtype=np.uint64)))
    assert sum(len(x.hashes) for x in catchers.levels) < 12_000


def _query(rows):
    out = []
    for d, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), 1 if d is None else zlib.crc32(str(d).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = _fast_runs(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((d, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return out


def _fast_runs(words):
    """As _runs, each period by one comparison of arrays, for long texts."""
    known = {}
    w = np.array([known.setdefault(x, len(known)) for x in words])
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], w[:-q] == w[q:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query(spark, small, same):
    expected = _query(small[1])
    assert sum(r[1] > 0 for r in expected) > len(expected) / 20
    same(op11_periodic_runs(spark, SF), COLUMNS, expected)


def test_edge_rows(spark, edge, edge_rows, same, tmp_path):
    """Nulls, empty and long texts (one of one word, 70,000 times), repeated rows, clashing columns."""
    edge.write.parquet(f"{tmp_path}/documents.parquet")
    same(op11_periodic_runs(spark, str(tmp_path)), COLUMNS, _query([(d, t) for d, t, *_ in edge_rows if d != 6]) + [_same_words()])


def _same_words():
    """The row of 70,000 equal words by hand, as trying all periods takes too long; the query's change leaves them equal."""
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (6, 1, 0, 70_000, 1, 70_000_000, sha("0,70000,1\n"), sha("same"))


def test_no_documents(spark, none):
    assert periodic_runs.digests(periodic_runs.periodic_runs(none)).count() == 0


def test_texts_and_spans(spark):
    docs = spark.createDataFrame([(1, "x a b a b a b a b y"), (2, "a a a a a"), (3, None), (None, "b b b b b b c")], "doc_id long, text string")
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(docs).collect()}
    assert got == {1: ([(1, 8, 2)], "x a b y"), 2: ([], "a a a a a"), 3: ([], ""), None: ([(0, 6, 1)], "b c")}


def test_wrong_hashes_are_done_anew(monkeypatch):
    """Where hashes of different words agree, the document's runs are found by exact numbers."""
    import pyarrow as pa

    from tidemark.llm import words

    monkeypatch.setattr(words.Words, "hashes", lambda self: np.zeros(self.first[-1], np.uint64))
    texts = ["a b a b a b a b c d e", "q w e r t z u i o p"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    got = periodic_runs._chunk(pa.array([1, 2]), data, np.array([0, len(texts[0]), len(data)]), None).to_pylist()
    assert [[tuple(r.values()) for r in x["runs"]] for x in got] == [[(0, 8, 2)], []]
    assert [x["collapsed"] for x in got] == ["a b c d e", texts[1]]


@pytest.mark.parametrize("n", [0, 1, 3, 5])
def test_short(n):
    assert periodic_runs.runs_of(np.zeros(n, np.uint64)) == []
