"""Guarded transitions: a log of commands folded by composing transition tables.

What a stretch of commands does depends on the state that it finds only: it is a table with an entry for each state.
Tables of neighbouring stretches compose, in any grouping, so a key's log is folded in stretches of a bounded size and
these once more, and no key's log is whole in one task. A command that its guard refuses changes nothing and is
counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import stretches

STATES = ("discovered", "fetch_pending", "fetched", "doc_created", "shared", "notified", "unknown", "manual", "baseline")


@dataclass(frozen=True)
class Command:
    """The state it leads to (None: it stays), the states that allow it, and what it does to the counts of failures."""

    to: str | None
    allowed: tuple[str, ...]
    fails: bool = False
    clears: bool = False


_OPEN = tuple(s for s in STATES if s != "notified")
#: What each command does.
COMMANDS = {
    "ask": Command("fetch_pending", ("discovered",)),
    "fetch": Command("fetched", ("fetch_pending",), clears=True),
    "create": Command("doc_created", ("fetched",), clears=True),
    "advance": Command(None, ("doc_created",), clears=True),
    "share": Command("shared", ("doc_created",), clears=True),
    "notify": Command("notified", ("shared",), clears=True),
    "retry": Command(None, tuple(s for s in _OPEN if s not in ("unknown", "manual")), fails=True),
    "lose": Command("unknown", _OPEN, fails=True),
    "stop": Command("manual", _OPEN, fails=True),
}
NAMES = tuple(COMMANDS)

_ENTRY = "struct<state:int,retries:bigint,cleared:boolean,failures:bigint,done:bigint,refused:bigint>"


def _entry(state: Column, retries: Column, cleared: Column, failures: Column, done: Column, refused: Column) -> Column:
    return F.struct(state.alias("state"), retries.alias("retries"), cleared.alias("cleared"), failures.alias("failures"), done.alias("done"), refused.alias("refused")).cast(_ENTRY)


def _unchanged() -> Column:
    return F.array(*[_entry(F.lit(i), F.lit(0), F.lit(False), F.lit(0), F.lit(0), F.lit(0)) for i in range(len(STATES))])


def _targets() -> Column:
    """The state after each command in each state, or -1 where its guard refuses; state by state."""
    return F.array(*[F.lit(-1 if s not in c.allowed else STATES.index(c.to or s)) for s in STATES for c in COMMANDS.values()])


def _step(x: Column, command: Column) -> Column:
    to = F.get(_targets(), x["state"] * len(NAMES) + command)
    ok = to >= 0
    of = lambda test: F.get(F.array(*[F.lit(test(c)) for c in COMMANDS.values()]), command) & ok
    fails, clears = of(lambda c: c.fails), of(lambda c: c.clears)
    return _entry(
        F.when(ok, to).otherwise(x["state"]), x["retries"] + fails.cast("long"), x["cleared"] | clears, F.when(clears, 0).otherwise(x["failures"] + fails.cast("long")), x["done"] + ok.cast("long"), x["refused"] + (~ok).cast("long")
    )


def _then(x: Column, table: Column) -> Column:
    """Entry x, and then what a table does to its state."""
    y = F.get(table, x["state"])
    return _entry(y["state"], x["retries"] + y["retries"], x["cleared"] | y["cleared"], F.when(y["cleared"], y["failures"]).otherwise(x["failures"] + y["failures"]), x["done"] + y["done"], x["refused"] + y["refused"])


def _folded(rows: Column, use) -> Column:
    return F.aggregate(rows, _unchanged(), lambda table, r: F.transform(table, lambda x: use(x, r)))


def tables(log: DataFrame, key: str, order: list[str], command: str, bits: int = stretches.BITS) -> DataFrame:
    """key, table: what the whole log of each key does, for each state that it may find. command: the number of a command in NAMES."""
    rows = stretches.numbered(log.select(key, *order, command), [key], order, bits=bits).withColumn("stretch", F.shiftright("at", bits))
    out = rows.groupBy(key, "stretch").agg(F.sort_array(F.collect_list(F.struct("at", F.col(command).alias("c")))).alias("rows"))  # a stretch
    out = out.select(key, "stretch", _folded(F.col("rows"), lambda x, r: _step(x, r["c"])).alias("table"))
    for level in ("further", "all"):
        up = F.shiftright("stretch", bits) if level == "further" else F.lit(0).cast("long")
        out = out.groupBy(key, up.alias("up")).agg(F.sort_array(F.collect_list(F.struct("stretch", "table"))).alias("rows"))
        out = out.select(key, F.col("up").alias("stretch"), _folded(F.col("rows"), lambda x, r: _then(x, r["table"])).alias("table"))
    return out.select(key, "table")


def states(log: DataFrame, key: str, order: list[str], command: str, first: Column | None = None, bits: int = stretches.BITS) -> DataFrame:
    """OX-1, OX-5: key, state, retries, failures (in a row), done and refused: how many commands took effect, and how many guards refused.

    `first`, a column of key, is the state that a log begins with: discovered, if not given.
    """
    start = F.lit(STATES[0]) if first is None else first
    x = F.get("table", F.array_position(F.array(*map(F.lit, STATES)), start).cast("int") - 1)
    out = tables(log, key, order, command, bits).select(key, x.alias("x"))
    return out.select(key, F.get(F.array(*map(F.lit, STATES)), F.col("x.state")).alias("state"), "x.retries", "x.failures", "x.done", "x.refused")
