"""op13: pieces against the library, the plan against packing one by one and against all ways."""

import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.llm import packing
from tidemark.llm.registry import WORD_FILE, op13_best_fit_packing
from tidemark.llm.token_files import new_path


def _one_by_one(lengths, capacity):
    """The number of sequences by the rule, applied to one piece after another."""
    rooms, large = [], sorted((x for x in lengths if 3 * x > capacity), reverse=True)
    while large:
        x = large.pop(0)
        y = next((y for y in large if x + y <= capacity), 0)
        if y:
            large.remove(y)
        rooms.append(capacity - x - y)
    for x in sorted((x for x in lengths if 3 * x <= capacity), reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else capacity) - x)
    return len(rooms)


def _fewest(lengths, capacity):
    @lru_cache(None)
    def best(items):
        if not items:
            return 0
        first, rest, out = items[0], items[1:], len(items)
        for mask in range(1 << len(rest)):
            mine = [x for i, x in enumerate(rest) if mask >> i & 1]
            if first + sum(mine) <= capacity:
                out = min(out, 1 + best(tuple(x for i, x in enumerate(rest) if not mask >> i & 1)))
        return out

    return best(tuple(sorted(lengths, reverse=True)))


def _check(rows, capacity):
    """rows: (sequence, offset, length). Gapless from 0 and no longer than capacity."""
    by = defaultdict(list)
    for s, o, n in rows:
        by[s].append((o, n))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def _by_plan(lengths, capacity):
    plan = packing.Plan(Counter(lengths), capacity)
    seen, number = Counter(), []
    for x in lengths:
        number.append(seen[x])
        seen[x] += 1
    sequence, offset = plan.finder()(np.array(lengths, np.int64), np.array(number, np.int64))
    used = _check(zip(sequence.tolist(), offset.tolist(), lengths, strict=True), capacity)
    assert used == plan.sequences
    return plan


@settings(max_examples=300, deadline=None)
@given(capacity=st.integers(4, 60), data=st.data())
def test_plan_is_that_of_one_by_one(capacity, data):
    lengths = data.draw(st.lists(st.integers(1, capacity), min_size=1, max_size=80))
    assert _by_plan(lengths, capacity).sequences == _one_by_one(lengths, capacity)


@settings(max_examples=60, deadline=None)
@given(capacity=st.integers(6, 40), data=st.data())
def test_large_pieces_take_the_fewest_sequences(capacity, data):
    lengths = data.draw(st.lists(st.integers(capacity // 3 + 1, capacity), min_size=1, max_size=8))
    assert _by_plan(lengths, capacity).sequences == _fewest(lengths, capacity)


def test_plan_stays_small():
    """Many pieces of all lengths, and a hot one: rows depend on the capacity, and little room is left."""
    rng = np.random.default_rng(3)
    lengths = np.minimum(4096, rng.lognormal(6, 1.2, 200_000).astype(int) + 1).tolist() + [777] * 100_000
    plan = _by_plan(lengths, 4096)
    assert len(plan.rows) < 40_000
    assert plan.sequences <= 1.001 * sum(lengths) / 4096 + 1


def _pieces(rows, capacity):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_FILE)
    out = []
    for d, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            out.append((d, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]


def test_query(spark, small, same):
    got = op13_best_fit_packing(spark, SF)
    expected = _pieces(small[1], 4096)
    same(got, COLUMNS, expected)
    rows = [tuple(r) for r in got.select("sequence_id", "offset", "length").collect()]
    assert _check(rows, 4096) == _one_by_one([r[3] for r in expected], 4096)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_edge_rows_and_sequences(spark, edge, pairs, same, capacity):
    """Nulls, empty and long texts, repeated rows, clashing columns; several parts; ids of the sequences."""
    path = new_path(spark, "test-pieces")
    packing.write_pieces(edge.repartition(3), path, WORD_FILE, capacity=capacity)
    pieces = packing.read_pieces(spark, path)
    packed = packing.placed(pieces.withColumn("ids_crc32", packing.crc32_of(F.col("ids"), 2)), capacity)
    expected = _pieces(pairs, capacity)
    same(packed, COLUMNS, expected)
    rows = packed.select("sequence_id", "offset", "length", "ids").collect()
    assert _check([tuple(r[:3]) for r in rows], capacity) == _one_by_one([r[3] for r in expected], capacity)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id][2 * r.offset : 2 * (r.offset + r.length)] == bytes(r.ids)


def test_no_documents(spark, none):
    path = new_path(spark, "test-pieces")
    packing.write_pieces(none, path, WORD_FILE)
    assert packing.placed(packing.read_pieces(spark, path)).count() == 0
