"""op12: the trie against a dictionary of all prefixes, with sketches of any size and stretches of a few rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tests.conftest import SF
from tidemark.llm import prefix_trie
from tidemark.llm.registry import op12_prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn int, role string, text string, conv string, at string, x string, depth string, `a.b` string"


def _ordered(rows):
    out = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            out[c].append((t is not None, t or 0, r or "", (x or "").encode()))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in out.items()}


def _rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def _nodes(convs):
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        saved[p] = sum(saved[c] for c in children[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(convs[c]) == len(p))
        out.append((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def _conversations(rng, n):
    """Copies, common beginnings, conversations that end inside others, equal turns, nulls and texts of several bytes a letter."""
    texts = ["", None, "a", "é日", "tell me more", "yes", *(f"t{i}" for i in range(5))]
    kinds = [[(rng.choice(["user", "assistant", None]), rng.choice(texts)) for _ in range(rng.randrange(1, 14))] for _ in range(6)]
    rows = []
    for c in rng.sample(range(-30, 4 * n), n):
        turns = rng.choice(kinds)[: rng.randrange(1, 14)] + [(rng.choice(["user", None]), rng.choice(texts)) for _ in range(rng.choice([0, 0, 1, 9]))]
        rows += [(c, rng.choice([k, k, k // 2, None]), r, x) for k, (r, x) in enumerate(turns)]
    return rows + [(None, 0, "user", "of none")]


@pytest.fixture(scope="module")
def rows():
    return _conversations(random.Random(8), 160)


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "a", "x", "d", "b") for r in rows], SCHEMA).repartition(3)


def test_query(spark, same):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = _nodes(_rebuilt(_ordered(rows)))
    assert max(r[3] for r in expected if r[1]) > 1
    same(op12_prefix_trie(spark, SF), COLUMNS, expected)


def test_query_of_edge_rows(spark, rows, same, tmp_path):
    _frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    expected = _nodes(_rebuilt(_ordered(rows)))
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in expected)  # some are turnless
    same(op12_prefix_trie(spark, str(tmp_path)), COLUMNS, expected)


@pytest.mark.parametrize("bits", [2, 8, 20])
def test_any_sketch_and_stretch(spark, rows, same, monkeypatch, bits):
    """A sketch of a few counters proves little, and the result is the same; so it is with stretches of two rows and pieces of a few ids."""
    monkeypatch.setattr(prefix_trie, "STRETCH_BITS", 1)
    turns = prefix_trie.turns_of(_frame(spark, rows))
    t = prefix_trie.trie(turns, prefix_trie.sizes_of(turns), least_bits=bits, most_bits=bits)
    expected = _nodes(_ordered(rows))
    same(prefix_trie.with_digests(t, piece=12), COLUMNS, expected)
    alone = sum(r[3] == 1 for r in expected)
    assert t.tails.count() <= alone and (t.tails.count() > 0.9 * alone) == (bits == 20)


def test_one_conversation_of_many_turns(spark, same):
    rows = [(7, k, "user", f"t{k % 50}") for k in range(5000)] + [(8, k, "user", f"t{k % 50}") for k in range(2000)]
    same(prefix_trie.with_digests(prefix_trie.trie(*(lambda t: (t, prefix_trie.sizes_of(t)))(prefix_trie.turns_of(_frame(spark, rows))))), COLUMNS, _long(rows))


def _long(rows):
    """Two conversations, the second the beginning of the first: by hand, as a dictionary of prefixes takes too long."""
    size, none = [len(r[3]) for r in rows[:5000]], hashlib.sha256(b"").hexdigest()
    sha = {2000: hashlib.sha256(b"8").hexdigest(), 5000: hashlib.sha256(b"7").hexdigest()}
    return [(7, d, 7 if d else None, 2 if d <= 2000 else 1, int(d < 5000), 1, sum(size[max(d, 1) - 1 : 2000]), sha.get(d, none)) for d in range(5001)]


def test_no_conversations(spark):
    turns = prefix_trie.turns_of(spark.createDataFrame([], SCHEMA))
    assert prefix_trie.with_digests(prefix_trie.trie(turns, prefix_trie.sizes_of(turns))).count() == 0
