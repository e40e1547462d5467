"""Dates in words: expressions are read as tokens on the driver, against a given day; feed dates are parsed as columns."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a word says, as (kind, value). The words of both languages.
WORDS: dict[str, tuple[str, int]] = {
    "today": ("day", 0), "yesterday": ("day", 1), "day before yesterday": ("day", 2), "今天": ("day", 0), "昨天": ("day", 1), "前天": ("day", 2), "大前天": ("day", 3),
    "days": ("unit", 1), "day": ("unit", 1), "天": ("unit", 1), "week": ("unit", 7), "周": ("unit", 7), "month": ("unit", 30), "个月": ("unit", 30), "月": ("unit", 30),
    "this": ("this", 0), "current": ("this", 0), "本": ("this", 0), "这": ("this", 0), "这个": ("this", 0), "当前": ("this", 0),
    "last": ("last", 0), "上": ("last", 0), "上个": ("last", 0), "past": ("past", 0), "最近": ("past", 0), "过去": ("past", 0), "近": ("past", 0),
    "ago": ("ago", 0), "前": ("ago", 0), "一": ("number", 1), "两": ("number", 2), "年": ("年", 0), "日": ("日", 0), "-": ("-", 0), "/": ("/", 0),
}
_ENGLISH = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
WORDS |= {x: ("weekday", i) for i, x in enumerate(_ENGLISH)} | {f"周{x}": ("weekday", i % 7) for i, x in enumerate("一二三四五六日")} | {"周天": ("weekday", 6)}
_MOST_DAYS = 365

Tokens = list[tuple[str, int]]


def tokens(words: str) -> Tokens:
    """Kinds and values of the numbers and known words of an expression, the longest word first; it ends before what is unknown."""
    text, at, out = words.strip().lower(), 0, []
    while at < len(text):
        if text[at] in " _\t":
            at += 1
        elif m := re.compile(r"\d+").match(text, at):
            out.append(("number", int(m[0])))
            at = m.end()
        else:
            word = max((w for w in WORDS if text.startswith(w, at)), key=len, default="")
            if not word:
                break
            out.append(WORDS[word])
            at += len(word)
    return out


def _monday(day: date) -> date:
    return day - timedelta(day.weekday())


def _month(day: date, back: int = 0) -> date:
    """The first of a month, or of one so many months before."""
    at = day.year * 12 + day.month - 1 - back
    return date(at // 12, at % 12 + 1, 1)


def _ago(as_of: date, n: int, unit: int) -> date:
    if unit != 1 or n > _MOST_DAYS:
        raise ValueError(f"not a number of days: {n}")
    return as_of - timedelta(n)


def _weekday(as_of: date, which: int) -> date:
    """The latest such day, today included."""
    return as_of - timedelta((as_of.weekday() - which) % 7)


def _dated(as_of: date, month: int, day: int) -> date:
    """Without a year: in this one, or the year before if the month is still to come."""
    return date(as_of.year - (month > as_of.month), month, day)


#: By kinds of tokens. Rules of one day are given the values in order.
_DAY_RULES: dict[tuple[str, ...], Callable[..., date]] = {
    ("day",): lambda t, n: t - timedelta(n),
    ("number", "unit", "ago"): lambda t, n, unit, _: _ago(t, n, unit),
    ("last", "weekday"): lambda t, _, w: _monday(t) - timedelta(7 - w),
    ("this", "weekday"): lambda t, _, w: _weekday(t, w),
    ("number", "-", "number", "-", "number"): lambda t, y, _, m, __, d: date(y, m, d),
    ("number", "/", "number", "/", "number"): lambda t, y, _, m, __, d: date(y, m, d),
    ("number", "年", "number", "unit", "number", "日"): lambda t, y, _, m, __, d, ___: date(y, m, d),
    ("number", "unit", "number", "日"): lambda t, m, _, d, __: _dated(t, m, d),
    ("number", "/", "number"): lambda t, m, _, d: _dated(t, m, d),
}


def _stretch(as_of: date, n: int) -> tuple[date, date]:
    return as_of - timedelta(n - 1), as_of


def _whole(as_of: date, unit: int, back: int) -> tuple[date, date]:
    """This week or month until today, or all of the one before."""
    if unit == 7:
        first = _monday(as_of) - timedelta(7 * back)
        return first, first + timedelta(6) if back else as_of
    if unit == 30:
        return _month(as_of, back), _month(as_of) - timedelta(1) if back else as_of
    raise ValueError("neither week nor month")


_RANGE_RULES: dict[tuple[str, ...], Callable[..., tuple[date, date]]] = {
    ("this", "unit"): lambda t, _, unit: _whole(t, unit, 0),
    ("last", "unit"): lambda t, _, unit: _whole(t, unit, 1),
    ("past", "unit"): lambda t, _, unit: _stretch(t, unit),
    ("past", "number", "unit"): lambda t, _, n, unit: _stretch(t, n * unit),
    ("last", "number", "unit"): lambda t, _, n, unit: _stretch(t, n * unit),
}


def _by(rules: dict, words: str, as_of: date):
    """The rule of as many tokens as any has, from the first on; what follows them says nothing."""
    found = tokens(words)
    for n in range(len(found), 0, -1):
        if rule := rules.get(tuple(kind for kind, _ in found[:n])):
            return rule(as_of, *(value for _, value in found[:n]))
    raise ValueError(f"no date: {words}")


def date_of(words: str, as_of: date) -> date:
    """DT-1: one day."""
    return _by(_DAY_RULES, words, as_of)


def range_of(words: str, as_of: date) -> tuple[date, date]:
    """DT-2: first and last day; this week and month end today, the last n days include it."""
    found = tokens(words)
    if [kind for kind, _ in found] == ["day"] and found[0][1] < 2:
        day = date_of(words, as_of)
        return day, day
    return _by(_RANGE_RULES, words, as_of)


def preset(name: str, as_of: date) -> tuple[date, date]:
    """DT-3: presets of the period comparison, where last week and month are the 7 and 30 days before today."""
    kinds = tokens(name)
    if [kind for kind, _ in kinds] == ["last", "unit"]:
        return as_of - timedelta(kinds[1][1]), as_of - timedelta(1)
    return range_of(name, as_of)


def feed_date(text: Column) -> Column:
    """DT-8: a feed's date, by mail's format (the weekday goes) or ISO's; null if it is neither."""
    mail = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3}, *", "")
    mail = F.regexp_replace(mail, r" (GMT|UTC|Z)$", " +0000")
    iso = F.regexp_replace(F.trim(text), "Z$", "+00:00")
    return F.coalesce(F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss xx")), F.when(iso.rlike(r"^\d{4}-\d{2}-\d{2}"), F.to_timestamp(F.try_to_timestamp(iso))))


def clock(text: Column) -> Column:
    """DT-7: the time's first five characters, behind the date if there is one."""
    return F.substring(F.element_at(F.split(text, " "), -1), 1, 5)
