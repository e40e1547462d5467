"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that the analytics' tokeniser leaves out. Fixed values.
STOP_WORDS = ("的", "了", "在", "是", "我", "有", "和", "就", "不", "人", "都", "一", "一个", "上", "也", "很", "到", "说", "要", "去", "你", "会", "着", "没有", "看", "好", "自己", "这")
#: Words that are never taken for topics by themselves. Fixed values.
AUTO_STOP_WORDS = (
    "的", "了", "在", "是", "我", "有", "和", "就", "不", "人", "都", "一",
    "一个", "上", "也", "很", "到", "说", "要", "去", "你", "会", "着", "没有",
    "看", "好", "自己", "这", "那", "来", "被", "与", "为", "对", "将", "从",
    "以", "及", "等", "但", "或", "而", "于", "中", "由", "可", "可以", "已",
    "已经", "还", "更", "最", "再", "因为", "所以", "如果", "虽然", "然而",
    "什么", "怎么", "如何", "哪", "哪些", "多少", "几", "这个", "那个",
    "他", "她", "它", "他们", "她们", "我们", "你们", "大家",
    "这样", "那样", "怎样", "这么", "那么", "多么", "非常", "特别",
    "应该", "可能", "能够", "需要", "必须", "一定", "肯定", "确实",
    "正在", "曾经", "将要", "即将", "刚刚", "马上", "立刻",
    "回应", "发布", "表示", "称", "曝", "官方", "最新", "重磅", "突发",
    "热搜", "刷屏", "引发", "关注", "网友", "评论", "转发", "点赞",
)


def _words(text: Column, pattern: str) -> Column:
    return F.filter(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), lambda w: F.length(w) >= 2)


def without_links(text: Column) -> Column:
    return F.regexp_replace(text, r"https?://[^ ]+", "")


def tokens_analytics(text: Column) -> Column:
    """TX-4: words of two or more letters, without links and stop words."""
    return F.filter(_words(without_links(text), r"[\p{L}\p{N}_]+"), lambda w: ~w.isin(*STOP_WORDS))


def tokens_search(text: Column) -> Column:
    """TX-5: words of two or more letters, without links and bracketed parts."""
    return _words(F.regexp_replace(without_links(text), r"\[[^\]]*\]", ""), r"[\p{L}\p{N}_]+")


def tokens_auto(text: Column) -> Column:
    """TX-6: runs of two or more CJK letters, or Latin words; stop words in any case go."""
    found = _words(text, r"[\x{4e00}-\x{9fff}]{2,}|[a-zA-Z]{2,}[a-zA-Z0-9]*")
    return F.filter(found, lambda w: ~F.lower(w).isin(*AUTO_STOP_WORDS))


def clean_title(text: Column) -> Column:
    """TX-7: runs of white space become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(text, r"[ \t\n\r]+", " "))


def html_escape(text: Column) -> Column:
    """TX-9: the five characters, the ampersand first."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def strip_tags(html: Column) -> Column:
    """TX-8: markup goes, the five common references are decoded, white space collapses."""
    text = F.regexp_replace(F.regexp_replace(html, r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " "), r"<[^>]*>", " ")
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return clean_title(text)


def truncate(text: Column, n: int) -> Column:
    """TX-10: cut to n characters, with dots if anything was cut."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def truncate_bytes(text: Column, n: int | Column) -> Column:
    """TX-11: the longest prefix of n UTF-8 bytes or fewer that ends with a whole character."""
    return F.when(F.octet_length(text) <= n, text).otherwise(F.regexp_replace(F.make_valid_utf8(F.substring(F.encode(text, "utf-8"), 1, n).cast("string")), "\\x{FFFD}+$", ""))


def truncate_lines(text: Column, n: int | Column) -> Column:
    """TX-11: whole lines of n UTF-8 bytes or fewer; a first line that is longer is cut by itself."""
    lines = F.transform(F.array(truncate_bytes(text, n)), lambda cut: F.coalesce(F.nullif(F.regexp_extract(cut, r"(?s)^(.+)\n", 1), F.lit("")), cut))[0]
    return F.when(F.octet_length(text) <= n, text).otherwise(lines)


#: What a message's foot begins with, the first that a text has. Fixed values.
FEET = ("\n\n\n> ", "\n\n> ", "\n\n<font", "\n\n_", "\n\n更新时间")


def _foot(text: Column) -> Column:
    """From the last place of the first mark that stands behind something."""
    after = {mark: F.substring_index(text, mark, -1) for mark in FEET}
    return F.coalesce(*[F.when(F.octet_length(x) < F.octet_length(text) - len(mark.encode()), F.concat(F.lit(mark), x)) for mark, x in after.items()], F.lit(""))


def truncate_before_foot(text: Column, n: int) -> Column:
    """TX-11: whole lines and the whole foot, n UTF-8 bytes or fewer together; a foot that takes all of it is cut like any line."""

    def cut(foot: Column) -> Column:  # looked for once
        size = F.octet_length(foot)
        body = F.substring(text, F.lit(1), F.length(text) - F.length(foot))
        return F.when((size == 0) | (size >= n), truncate_lines(text, n)).otherwise(F.concat(truncate_lines(body, n - size), foot))

    return F.when(F.octet_length(text) <= n, text).otherwise(F.transform(F.array(_foot(text)), cut)[0])


def to_mrkdwn(text: Column) -> Column:
    """TX-13: links and bold of Markdown as Slack writes them."""
    return F.regexp_replace(F.regexp_replace(text, r"\[([^\]]+)\]\(([^)]+)\)", "<$2|$1>"), r"\*\*([^*]+)\*\*", "*$1*")


def escape_markdown(text: Column) -> Column:
    """TX-21: backslash and brackets."""
    return F.regexp_replace(text, r"([\\\[\]])", r"\\$1")


def chunks(text: Column, n: int) -> Column:
    """TX-20: parts of n characters."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length(text) / n).cast("int") - 1, F.lit(0))), lambda i: F.substring(text, i * n + 1, F.lit(n)))


def fenced(text: Column) -> Column:
    """TX-18: what stands in the first fence, or the trimmed text."""
    inner = F.regexp_extract(text, r"(?s)```(?:json)?[ \n]*(.*?)[ \n]*```", 1)
    return F.when(inner != "", inner).otherwise(F.trim(text))


def matches(title: Column, word: str, regex: bool = False) -> Column:
    """TX-2: substring of the lower-cased title, or a regular expression in any case."""
    low = F.lower(title)
    return low.rlike(f"(?i){word}") if regex else F.contains(low, F.lit(word.lower()))
