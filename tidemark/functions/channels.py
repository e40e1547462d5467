"""How texts and titles are written for each channel: what it makes of each element of Markdown, and the steps that follow from it.

A step is (pattern, replacement) with \\1 for a group, so the same list makes a column expression and SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import markdown


def _between(mark: str, inner: str = ".+?") -> str:
    quoted = "".join(f"\\{x}" for x in mark)
    return f"{quoted}({inner}){quoted}"


def _lines(begin: str, rest: str = "") -> str:
    """What begins each line, and the line."""
    return f"(?m)^{begin}[ \\t]*{rest}"


def _held(opening: str, closing: str) -> str:
    return rf"\{opening}([^\{closing}]+)\{closing}"


#: Elements of Markdown, as patterns.
SYNTAX = {
    "font": "<font[^>]*>(.+?)</font>", "tag": "<[^>]+>", "bold": _between("**"), "bold only": _between("**", "[^*]+"), "italic": _between("*"), "strike": _between("~~"), "code": _between("`"),
    "link": _held("[", "]") + _held("(", ")"), "rule": _lines("[-*]{3,}", "$"), "quote": _lines(">"), "quotation": "(?m)(^>[^\\n]*(?:\\n>[^\\n]*)*)", "heading": _lines("#{1,6}", "(.+)$"), "head": _lines("#+"),
    "&": "&", "<": "<", ">": ">", "(": "\ue000", ")": "\ue001", "line": "\\n", **{f"h{n}": f"(?m)^{'#' * n} (.+)$" for n in (1, 2, 3)}, "large": "(?m)^#{1,2}[ \\t]+(.+)$", **{f"{n} blank": f"\\n{{{n + 1},}}" for n in (2, 3)},
}

_HEADING, _STRIKE, _NO_FONT = ("heading", r"**\1**"), ("strike", r"\1"), ("font", r"\1")
_BLANK, _ESCAPED = ("2 blank", "\n\n"), (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"))
#: TX-14: what each channel makes of elements, in order. The two private letters stand for the marks of a quotation while the text is escaped.
DIALECTS: dict[str, tuple[tuple[str, str], ...]] = {
    "feishu": (_HEADING, ("quote", ""), _BLANK),
    "dingtalk": (_NO_FONT, ("large", r"### \1"), _STRIKE, _BLANK),
    "wework": (_NO_FONT, _HEADING, ("rule", "\n\n"), _STRIKE, ("3 blank", "\n\n\n")),
    "ntfy": (_NO_FONT, _BLANK),
    "bark": (_NO_FONT, _HEADING, ("rule", "\n"), ("quote", ""), _STRIKE, _BLANK),
    "slack": (_NO_FONT, ("link", r"<\2|\1>"), _HEADING, ("rule", ""), ("strike", r"~\1~"), ("bold only", r"*\1*"), _BLANK),
    "telegram": (
        _NO_FONT, ("quotation", "\ue000\n\\1\n\ue001"), _HEADING, ("rule", ""), ("quote", ""), *_ESCAPED, ("(", "<blockquote>"), (")", "</blockquote>"),
        ("link", r'<a href="\2">\1</a>'), ("bold", r"<b>\1</b>"), ("italic", r"<i>\1</i>"), ("strike", r"<s>\1</s>"), ("code", r"<code>\1</code>"), _BLANK,
    ),
    "html": (
        *_ESCAPED, ("link", r'<a href="\2">\1</a>'), *((f"h{n}", rf"<h{n}>\1</h{n}>") for n in (3, 2, 1)), ("bold", r"<strong>\1</strong>"), ("italic", r"<em>\1</em>"), ("strike", r"<del>\1</del>"),
        ("code", r"<code>\1</code>"), ("rule", "<hr>"), ("line", "<br>\n"),
    ),
}
#: What `plain` does to a text without images, underscores and addresses, in steps; for SQL.
_PLAIN = (("rule", ""), ("link", r"\1 \2"), _NO_FONT, ("tag", ""), ("quote", ""), ("head", ""), *((x, r"\1") for x in ("bold", "italic", "strike", "code")), _BLANK)


def steps(channel: str) -> list[tuple[str, str]]:
    return [(SYNTAX[x], by) for x, by in (_PLAIN if channel == "plain" else DIALECTS[channel])]


def rewritten(text: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, by in steps:
        text = F.regexp_replace(text, pattern, by.replace("$", r"\$").replace("\\1", "$1").replace("\\2", "$2"))
    return F.btrim(text, F.lit(" \t\n"))


def rewritten_sql(text: str, steps: list[tuple[str, str]]) -> str:
    quoted = lambda x: x.replace("'", "''")
    for pattern, by in steps:
        text = f"regexp_replace({text}, '{quoted(pattern)}', '{quoted(by)}', 'g')"
    return f"trim({text}, ' ' || chr(9) || chr(10))"


def adapted(text: Column, channel: str) -> Column:
    return rewritten(text, steps(channel))


def plain(text: Column) -> Column:
    """TX-12."""
    return markdown.plain(text)


@dataclass(frozen=True)
class Line:
    """Parts of a title's line, as printf formats."""

    link: str = "[%1$s](%2$s)"
    source: str = "[%s] "
    time: str = " - %s"
    count: str = " (%d次)"


#: TX-15. What each channel shows.
LINES = {
    "feishu": Line(source="<font color='grey'>&#91;%s&#93;</font> ", time=" <font color='grey'>- %s</font>", count=" <font color='green'>(%d次)</font>"),
    "dingtalk": Line(),
    "wework": Line(),
    "bark": Line(),
    "telegram": Line(link='<a href="%2$s">%1$s</a>', time=" <code>- %s</code>", count=" <code>(%d次)</code>"),
    "ntfy": Line(time=" `- %s`", count=" `(%d次)`"),
    "slack": Line(link="<%2$s|%1$s>", time=" `- %s`", count=" `(%d次)`"),
}


def title_line(channel: str, title: Column, url: Column, source: Column, time: Column, count: Column, is_new: Column) -> Column:
    """The line of one title; an empty url or time and a count of one are not shown."""
    of = LINES[channel]
    linked = F.when(url != "", F.format_string(of.link, title, url)).otherwise(title)
    new = F.when(is_new, "🆕 ").otherwise("")
    shown = F.when(time != "", F.format_string(of.time, time)).otherwise("")
    times = F.when(count > 1, F.format_string(of.count, count)).otherwise("")
    return F.concat(F.format_string(of.source, source), new, linked, shown, times)


def timeline_text(points: Column) -> Column:
    """TX-17: rank(time) in order, 0 for a gap; a dash without points. points: structs of time and rank."""
    one = lambda p: F.concat(F.coalesce(p["rank"], F.lit(0)).cast("string"), F.lit("("), F.replace(p["time"], F.lit("-"), F.lit(":")), F.lit(")"))
    return F.when(F.size(points) > 0, F.array_join(F.transform(points, one), "→")).otherwise("-")


def time_range(first: Column, last: Column) -> Column:
    """TX-17: first~last, or one of them if they are equal."""
    return F.when((first == last) | (last == "-"), first).otherwise(F.concat(first, F.lit("~"), last))
