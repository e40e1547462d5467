"""Messages against a loop that fills one after another."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.operators import delivery as D
from tidemark.operators import stretches
from tidemark.operators.splitting import split_lines, split_text
from tidemark.plans.message_queries import numbered_messages

AT = "2024-01-30 23:59:59"


def _bytes(x):
    return len(x.encode())


def _dealt(units, most):
    """units: (size, left, extra). The message of each and whether it starts it."""
    out, size, message = [], None, 0
    for own, left, extra in units:
        starts = size is None or size + own > most
        message, size = (message + 1 + extra, left) if starts else (message, size + own)
        out.append((message, starts))
    return out


@pytest.mark.parametrize("bits", [0, 1, 3, 12])
def test_dealt(spark, bits):
    """Keys of any length, units larger than a message, and those that fill several; stretches of one unit and of all."""
    rng = random.Random(3)
    keys = {f"k{i}": [(n := rng.choice([1, 3, 7, 20, 45, 130]), n + rng.choice([0, 5, 9]), rng.choice([0, 0, 0, 2])) for _ in range(rng.choice([1, 2, 30, 90]))] for i in range(12)}
    rows = [(k, i, *u, "more") for k, units in keys.items() for i, u in enumerate(units)]
    df = spark.createDataFrame(rows, "key string, at long, size long, left long, extra long, text string").repartition(3)
    got = {(r.key, r.at): (r.message, r.starts, r.text) for r in D.dealt(df, 100, bits).collect()}
    assert got == {(k, i): (*x, "more") for k, units in keys.items() for i, x in enumerate(_dealt(units, 100))}


def test_tables_are_short():
    """A stretch of many units has a row for each place where the first break may come, which the size of a message bounds."""
    import numpy as np

    n = 4096
    b = D.Breaks(np.full(n, 20), np.full(n, 30), np.zeros(n, np.int64), 4000)
    assert len(b.table()) <= 4000 / 20 + 2


@pytest.mark.parametrize("bits", [0, 2, 12])
def test_numbers_of_rows(spark, bits):
    rows = [(k, j * 7 % n, j) for k, n in (("a", 50), ("b", 1), ("c", 7)) for j in range(n)]
    df = spark.createDataFrame(rows, "key string, o int, x int").repartition(5)
    for r in stretches.numbered(df, ["key"], ["o", "x"], bits=bits).collect():
        assert r.at == sorted((o, x) for k, o, x in rows if k == r.key).index((r.o, r.x))


def _report(items, style, base, at):
    """The report's messages, unit by unit; items: (region, region_title, group_no, group_name, line) in order."""
    foot = style.foot % at
    room = style.cap - D.reserve(style) - _bytes(foot)
    done, held = [], None
    regions = list(dict.fromkeys(x[:2] for x in items))

    def add(text, fresh):
        nonlocal held
        if held is not None and _bytes(held + text) < room:
            held += text
            return
        if held is not None:
            done.append(held)
        *full, held = split_lines(fresh, room, base) if _bytes(fresh) > room else [fresh]
        done.extend(full)

    for region in regions:
        own = [x for x in items if x[:2] == region]
        head = f"📊 {style.bold}{region[1]}{style.bold} (共 {len(own)} 条)\n\n"
        add(("" if region == regions[0] else style.rule) + head, base + head)
        groups = list(dict.fromkeys(x[2:4] for x in own))
        for group in groups:
            lines = [x[4] for x in own if x[2:4] == group]
            n = len(lines)
            loud = style.bold if n >= 5 else ""
            top = f"{'🔥' if n >= 10 else '📈' if n >= 5 else '📌'} {style.bold}{group[1]}{style.bold} : {loud}{n}{loud} 条\n\n"
            for k, line in enumerate(lines):
                shown = f"  {k + 1}. {line}\n" + ("\n" if k + 1 < n else "")
                add(("" if k else ("" if group == groups[0] else style.gap) + top) + shown, base + head + top + shown)
    done.append(held)
    n = len(done)
    bodies = [(style.number % (i, n) if n > 1 else "") + x + foot for i, x in enumerate(done, 1)]
    return [(i, n + 1 - i if style.reverse else i, x) for i, x in enumerate(bodies, 1)]


@pytest.mark.parametrize("channel", list(D.STYLES))
def test_reports(spark, channel):
    """All channels, with a small cap: a long line fills messages of its own, and stretches have two units."""
    from dataclasses import replace

    style = replace(D.STYLES[channel], cap=420)
    rng = random.Random(channel)
    items = {}
    for key in ("2024-01-01", "2024-01-02", "one"):
        rows = []
        for region in range(3):
            for group in range(rng.randrange(1, 4)):
                rows += [(region, f"区{region}", f"g{group}", f"组 {group}", rng.choice(["短", "a longer title of some words", "长" * 30, "x" * 900 if j == 1 else "y"])) for j in range(rng.choice([1, 3, 6, 12]))]
        items[key] = rows if key != "one" else [(1, "区", "g", "n", "line")]
    flat = []
    for key, rows in items.items():
        seen = {}
        for x in rows:
            seen[x[:4]] = seen.get(x[:4], -1) + 1
            flat.append((key, x[0], x[1], x[2], x[3], seen[x[:4]], x[4]))
    df = spark.createDataFrame(flat, "key string, region int, region_title string, group_no string, group_name string, place long, line string")
    got = D.reports(df, style, F.concat(F.lit("报告 "), "key", F.lit(" "), F.col("total").cast("string"), F.lit("\n\n")), AT, bits=1)
    out = {}
    for r in got.collect():
        out.setdefault(r.key, []).append((r.batch, r.sent, r.body))
    for key, rows in items.items():
        expected = _report(rows, style, f"报告 {key} {len(rows)}\n\n", AT)
        assert sorted(out[key]) == expected
        assert all(_bytes(x) <= style.cap for _, _, x in expected) or len(expected) > 99


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet="ab日\n", max_size=80), head=st.sampled_from(["", "h\n", "头\n", "x" * 30]), most=st.integers(8, 40))
def test_split_lines(text, head, most):
    parts = split_lines(text, most, head)
    used = head if 2 * _bytes(head) <= most else ""
    assert all(_bytes(x) <= most for x in parts) and all(x.startswith(used) for x in parts[1:])
    assert "".join(x[len(used) * (i > 0) :] for i, x in enumerate(parts)) == text


def test_numbered_messages(spark):
    """The query against the splitter and numbers one by one."""
    import hashlib

    expected = set()
    for d, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        for channel in ("ntfy", "telegram"):
            style = D.STYLES[channel]
            parts = split_text(text or "", style.cap - D.reserve(style))
            for i, x in enumerate(parts, 1):
                body = (style.number % (i, len(parts)) if len(parts) > 1 else "") + x
                assert _bytes(body) <= style.cap
                expected.add((channel, d, i, len(parts) + 1 - i if style.reverse else i, _bytes(body), hashlib.sha256(body.encode()).hexdigest()))
    assert {tuple(r) for r in numbered_messages(spark, SF).collect()} == expected


@pytest.mark.parametrize("bits", [1, 12])
def test_spaced(spark, bits):
    """Rows at least so far apart, with ties, against a loop."""
    rng = random.Random(12)
    rows = [(k, rng.randrange(400), i) for i in range(300) for k in (rng.choice([1, 2, 2, 3]),)]
    expected = set()
    for k in (1, 2, 3):
        last = None
        for _, t, i in sorted(r for r in rows if r[0] == k):
            if last is None or t - last >= 25:
                last = t
                expected.add((k, t, i))
    got = D.spaced(spark.createDataFrame(rows, "k long, t long, i long").repartition(3), "k", "t", ["i"], 25, bits)
    assert {tuple(r) for r in got.select("k", "t", "i").collect()} == expected


def test_tables_of_units_without_size():
    """Sizes of 0 add no entry that another one ties with, so sorting by size alone decides."""
    import numpy as np

    for sizes in ([0, 0, 3, 0, 0], [0, 9, 0, 9, 0, 0], [0], [25, 0, 0]):
        n = np.zeros(len(sizes), np.int64)
        upto = [x[0] for x in D.Breaks(np.array(sizes), n, n, 24).table()]
        assert len(set(upto)) == len(upto)


def test_alerts_of_parts_of_seconds(spark, tmp_path):
    """Times are rounded to the nearest second, as in the SQL, before they are compared."""
    import duckdb

    from tidemark.plans.registry import oracle_sql, queries

    ts = ["00:00:00.6", "06:00:00.4", "06:00:00.7", "12:00:00.5", "12:00:01.5", "18:00:01.4", "18:00:01.6"]
    con = duckdb.connect()
    con.sql("CREATE TABLE events AS SELECT * FROM (VALUES " + ", ".join(f"({i}::BIGINT, TIMESTAMP '2024-01-01 {t}', 1::BIGINT, 'error')" for i, t in enumerate(ts)) + ") AS e(event_id, ts, user_id, event_type)")
    con.sql(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT PARQUET)")
    got = {(r.kind, r.event_id) for r in queries()["alerts_sent"](spark, str(tmp_path)).collect()}
    assert got == set(con.sql(oracle_sql()["alerts_sent"]).fetchall())


def test_reports_deal_units_once(spark):
    """Sizes, bodies, numbers and totals read the dealt units from a checkpoint, and none deals them again."""
    rows = [("2024-01-01", 0, "区", "g", "组", i, f"line {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "key string, region int, region_title string, group_no string, group_name string, place long, line string")
    got = D.reports(df, D.STYLES["wework"], F.col("key"), AT)
    assert "FlatMapCoGroupsInPandas" not in got._jdf.queryExecution().toString()
    assert got.count() == 1
