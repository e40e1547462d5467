"""Composed tables against a sequential loop."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import transitions as T


def _run(commands, state="discovered"):
    retries = failures = done = refused = 0
    for name in commands:
        c = T.COMMANDS[name]
        if state not in c.allowed:
            refused += 1
            continue
        state, done = c.to or state, done + 1
        failures = 0 if c.clears else failures + c.fails
        retries += c.fails
    return state, retries, failures, done, refused


@pytest.mark.parametrize("bits", [0, 1, 3, 12])
def test_states(spark, bits):
    """Logs of any length, with ties in order broken by a second column; stretches of one command, of two, of all."""
    rng = random.Random(9)
    good = ["ask", "fetch", "create", "advance", "share", "notify"]
    logs = {k: [good[min(i, 5)] if rng.random() < 0.6 else rng.choice(T.NAMES[:7] if k % 2 else T.NAMES) for i in range(rng.choice([1, 2, 7, 30]))] for k in range(60)}
    rows = [(k, i // 2, i, T.NAMES.index(c)) for k, log in logs.items() for i, c in enumerate(log)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, t int, no int, c int").repartition(3)
    got = {r.k: tuple(r)[1:] for r in T.states(df, "k", ["t", "no"], "c", bits=bits).collect()}
    assert got == {k: _run(log) for k, log in logs.items()}
    assert len({x[0] for x in got.values()}) > 4 and max(x[4] for x in got.values()) > 3


def test_states_to_begin_with(spark):
    log = [("share", "notify"), ("retry", "stop"), ("lose", "retry")]
    rows = [(i, j, T.NAMES.index(c)) for i in range(len(log)) for j, c in enumerate(log[i])]
    first = F.when(F.col("k") == 0, "doc_created").when(F.col("k") == 1, "notified").otherwise("baseline")
    got = {r.k: tuple(r)[1:] for r in T.states(spark.createDataFrame(rows, "k long, no int, c int"), "k", ["no"], "c", first).collect()}
    assert got == {0: _run(log[0], "doc_created"), 1: _run(log[1], "notified"), 2: _run(log[2], "baseline")}
    assert got[1][0] == "notified" and got[2][0] == "unknown"


def test_no_log(spark):
    assert T.states(spark.createDataFrame([], "k long, no int, c int"), "k", ["no"], "c").count() == 0
