from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import channels, dates
from tidemark.operators.splitting import split_text
from tidemark.sources import sinks

AS_OF = date(2024, 1, 30)  # a Tuesday


@pytest.mark.parametrize(
    ("words", "day"),
    [
        ("today", "2024-01-30"), ("昨天", "2024-01-29"), ("3 days ago", "2024-01-27"), ("5天前", "2024-01-25"), ("last monday", "2024-01-22"), ("this friday", "2024-01-26"), ("this tuesday", "2024-01-30"),
        ("上周日", "2024-01-28"), ("本周一", "2024-01-29"), ("2023-10-9", "2023-10-09"), ("12月5日", "2023-12-05"), ("2022年1月2日", "2022-01-02"), ("1/15", "2024-01-15"), ("2021/03/04", "2021-03-04"),
    ],
)
def test_date_of(words, day):
    assert str(dates.date_of(words, AS_OF)) == day


@pytest.mark.parametrize(
    ("words", "first", "last"),
    [("this week", "2024-01-29", "2024-01-30"), ("last week", "2024-01-22", "2024-01-28"), ("本月", "2024-01-01", "2024-01-30"), ("last month", "2023-12-01", "2023-12-31"), ("last 3 days", "2024-01-28", "2024-01-30"), ("最近5天", "2024-01-26", "2024-01-30"), ("past month", "2024-01-01", "2024-01-30")],
)
def test_range_of(words, first, last):
    assert tuple(map(str, dates.range_of(words, AS_OF))) == (first, last)


def test_presets_and_refusals():
    assert tuple(map(str, dates.preset("last_week", AS_OF))) == ("2024-01-23", "2024-01-29")
    assert tuple(map(str, dates.preset("this_week", AS_OF))) == ("2024-01-29", "2024-01-30")
    for words in ("", "soon", "400 days ago", "2024-02-31"):
        with pytest.raises(ValueError):
            dates.date_of(words, AS_OF)
    with pytest.raises(ValueError):
        dates.range_of("someday", AS_OF)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aé日😀 \n", max_size=200), st.integers(4, 40))
def test_split_text(text, most):
    parts = split_text(text, most)
    assert all(len(x.encode()) <= most for x in parts)
    assert "".join("".join(parts).split("\n")) == "".join(text.split("\n"))


def test_channels(spark):
    text = "# Head\n> a & b\n> c\n\n\n\n---\n**x** ~~y~~ [l](u)"
    got = spark.createDataFrame([(text,)], "t string").select(*[channels.adapted(F.col("t"), k).alias(k) for k in channels.DIALECTS], channels.plain(F.col("t")).alias("plain")).first()
    assert got.feishu == "**Head**\na & b\nc\n\n---\n**x** ~~y~~ [l](u)"
    assert got.dingtalk == "### Head\n> a & b\n> c\n\n---\n**x** y [l](u)"
    assert got.telegram == '<b>Head</b>\n<blockquote>\na &amp; b\nc\n</blockquote>\n\n<b>x</b> <s>y</s> <a href="u">l</a>'
    assert got.plain == "Head\na & b\nc\n\nx y l u"


def test_days_are_replaced_alone(spark, tmp_path):
    path = f"{tmp_path}/days"
    day = lambda d, x: spark.createDataFrame([(d, x)], "crawl_date string, x int")
    sinks.write_days(day("2024-01-01", 1).union(day("2024-01-02", 2)), path)
    sinks.write_days(day("2024-01-02", 3).withColumn("y", F.lit("new")), path)
    got = {str(r.crawl_date): (r.x, r.y) for r in sinks.read_days(spark, path).collect()}
    assert got == {"2024-01-01": (1, None), "2024-01-02": (3, "new")}


def test_report_is_written_in_order(spark, tmp_path):
    rows = [("b", 1, "t<1>", "u1"), ("a", 2, "t2", "u2"), ("a", 1, "t3", None)]
    lines = sinks.report_lines(spark.createDataFrame(rows, "g string, k int, t string, u string"), "g", "k", "t", "u", F.lit("now"))
    sinks.write_report(lines, f"{tmp_path}/report", "g")
    got = "".join(p.read_text() for p in sorted((tmp_path / "report").glob("part-*"))).splitlines()
    assert got == ["<h2>a (2)</h2>", '<li><a href="">t3</a> <small>now</small></li>', '<li><a href="u2">t2</a> <small>now</small></li>', "<h2>b (1)</h2>", '<li><a href="u1">t&lt;1&gt;</a> <small>now</small></li>']
