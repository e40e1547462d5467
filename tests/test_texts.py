"""Dates in words, plain texts and cuts, against examples and plain loops."""

import hashlib
import random
import re
from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF
from tidemark.functions import dates, markdown
from tidemark.functions.text import FEET
from tidemark.plans.tool_queries import cut_texts, plain_texts


@pytest.mark.parametrize(
    ("text", "plain"),
    [
        ("**bold** and __bold__, *it* and _it_, ~~old~~ `code`", "bold and bold, it and it, old code"),
        ("see https://a.example/x_y_z/__init__.py_ now_", "see https://a.example/x_y_z/__init__.py_ now_"),
        ("**see https://a.example/a**b and go**", "see https://a.example/a**b and go"),
        ("[name](https://a.example/_x_)", "name https://a.example/_x_"),
        ("![a picture](https://a.example/p.png)", "a picture"),
        ("snake_case_name and 2 * 3 * 4", "snake_case_name and 2  3  4"),
        ("***both***", "both"),
        ("# Head\n> quoted\n\n\n\n---\nend", "Head\nquoted\n\nend"),
        ("<font color='red'>red</font> <b>x</b> 1 < 2", "red x 1 < 2"),
        ("****", ""),
        ("a ** b", "a ** b"),
        ("", ""),
    ],
)
def test_plain_text(text, plain):
    assert markdown.plain_text(text) == plain


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["*", "**", "_", "__", "~~", "`", "a", "b ", " ", "\n", "é", "https://u/x_y*z "]), max_size=30).map("".join))
def test_plain_text_keeps_words_and_addresses(text):
    """Nothing but signs goes, addresses stay, and a second pass over a text without pairs changes nothing."""
    plain = markdown.plain_text(text)
    letters = lambda x: re.sub(r"[*_~`\s-]", "", re.sub(r"https?://\S+", "", x))
    assert letters(plain) == letters(text)
    assert plain.count("https://u/x_y*z") == text.count("https://u/x_y*z")
    if not set(text) & set("*_~`"):
        assert plain == re.sub(r"\n{3,}", "\n\n", "\n".join(text.split("\n"))).strip(" \n")


def test_plain_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = {(r.doc_id, len(r.text) - len(p), hashlib.sha256(p.encode()).hexdigest()) for r in docs for p in [markdown.plain_text(r.text)]}
    assert {tuple(r) for r in plain_texts(spark, SF).collect()} == expected


def _cuts(text, n):
    """The three cuts by bytes of the whole text."""

    def by_bytes(x, n):
        return x.encode()[:n].decode(errors="ignore")

    def by_lines(x, n):
        if len(x.encode()) <= n:
            return x
        short = by_bytes(x, n)
        return short[: short.rfind("\n")] if short.rfind("\n") > 0 else short

    if len(text.encode()) <= n:
        return {"bytes": text, "lines": text, "foot": text}
    at = next((text.rfind(m) for m in FEET if text.rfind(m) > 0), -1)
    foot = text[at:] if at > 0 else ""
    kept = by_lines(text[:at], n - len(foot.encode())) + foot if foot and len(foot.encode()) < n else by_lines(text, n)
    return {"bytes": by_bytes(text, n), "lines": by_lines(text, n), "foot": kept}


def test_cut_texts(spark):
    foot = "\n\n> 更新时间：2024-01-30 23:59:59"
    expected = set()
    for d, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        expected |= {(d, k, len(x.encode()), hashlib.sha256(x.encode()).hexdigest()) for k, x in _cuts(text + foot, 1000).items()}
    got = {tuple(r) for r in cut_texts(spark, SF).collect()}
    assert got == expected and any(k == "foot" and b < 1000 for _, k, b, _ in got)


def test_cuts_of_edge_texts(spark):
    from pyspark.sql import functions as F

    from tidemark.functions import text as X

    rng = random.Random(2)
    texts = ["", "é" * 40, "short\n\n> foot", "a\n" * 40 + "\n\n_foot_", "x" * 50 + "\n\n> " + "f" * 60, "\n" + "y" * 60, "a\n\n> b\n\n> c" * 5]
    texts += ["".join(rng.choice(["日", "a", "\n", "\n\n> ", "\n\n_"]) for _ in range(60)) for _ in range(200)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string")
    t = F.col("text")
    for r in df.select("i", X.truncate_bytes(t, 30).alias("bytes"), X.truncate_lines(t, 30).alias("lines"), X.truncate_before_foot(t, 30).alias("foot")).collect():
        assert {k: r[k] for k in ("bytes", "lines", "foot")} == _cuts(texts[r.i], 30), texts[r.i]


AS_OF = date(2024, 1, 30)


@pytest.mark.parametrize("n", [0, 1, 9, 30, 365])
def test_days_ago(n):
    for words in (f"{n} days ago", f"{n} day ago", f"{n}天前", f"  {n} Days  Ago", f"{n} days ago at noon"):
        assert dates.date_of(words, AS_OF) == AS_OF - timedelta(n)
    if n:
        for words in (f"last {n} days", f"past {n} days", f"最近{n}天", f"last_{n}_days"):
            assert dates.range_of(words, AS_OF) == (AS_OF - timedelta(n - 1), AS_OF)


def test_every_weekday():
    monday = date(2024, 1, 29)
    for i, (en, zh) in enumerate(zip(("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"), "一二三四五六日", strict=True)):
        assert dates.date_of(f"last {en}", AS_OF) == dates.date_of(f"上周{zh}", AS_OF) == monday - timedelta(7 - i)
        this = dates.date_of(f"this {en}", AS_OF)
        assert this == dates.date_of(f"本周{zh}", AS_OF) and this.weekday() == i and AS_OF - timedelta(6) <= this <= AS_OF
    assert dates.date_of("上周天", AS_OF) == dates.date_of("上周日", AS_OF)


@pytest.mark.parametrize(
    ("words", "days"),
    [("最近一周", 7), ("过去一周", 7), ("past week", 7), ("最近两周", 14), ("过去两周", 14), ("最近一个月", 30), ("过去一个月", 30), ("past month", 30)],
)
def test_stretches(words, days):
    assert dates.range_of(words, AS_OF) == (AS_OF - timedelta(days - 1), AS_OF)


@pytest.mark.parametrize("words", ["current week", "这周", "当前周", "本周"])
def test_this_week(words):
    assert dates.range_of(words, AS_OF) == (date(2024, 1, 29), AS_OF)


@pytest.mark.parametrize("words", ["这个月", "当前月", "current month"])
def test_this_month(words):
    assert dates.range_of(words, AS_OF) == (date(2024, 1, 1), AS_OF)


@pytest.mark.parametrize("words", ["", "tomorrow", "400 days ago", "13月1日", "2023-02-29", "3 weeks ago", "days", "last"])
def test_no_date(words):
    with pytest.raises(ValueError):
        dates.date_of(words, AS_OF)


def test_foot_is_looked_for_once(spark):
    """The foot begins at the last place of the first mark that stands behind something, as its pattern says; the plan has one search for it."""
    from pyspark.sql import functions as F

    from tidemark.functions import text as X

    rng = random.Random(12)
    texts = ["".join(rng.choice(("\n", "\n\n> ", "\n\n\n> ", "\n\n<font", "\n\n_", "\n\n更新时间", "é", "x> ", "_")) for _ in range(rng.randrange(12))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")

    def foot(text):
        return next((m[1] for m in (re.search(f"(?s)^.+({mark}.*)$", text) for mark in X.FEET) if m), "")

    assert [r.foot for r in df.select("i", X._foot(F.col("t")).alias("foot")).orderBy("i").collect()] == [foot(x) for x in texts]
    plan = df.select(X.truncate_before_foot(F.col("t"), 1000).alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<font") == 3  # where the mark is looked for, in the test and in the result, and what is put before it


def test_python_stages_get_few_long_texts_at_a_time(spark):
    """A batch of whole texts is what a Python worker's memory follows."""
    from tidemark.plans.message_queries import numbered_messages

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    spark.conf.set(name, "10000")
    try:
        numbered_messages(spark, SF)
        assert int(spark.conf.get(name)) <= 500
    finally:
        spark.conf.set(name, was)
