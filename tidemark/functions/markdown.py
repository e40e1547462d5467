"""Markdown as spans: marks are paired among spans, and addresses are spans that no mark reaches into."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Marks of spans, and whether one stands only at the edges of words.
MARKS = {"**": False, "__": True, "*": False, "_": True, "~~": False, "`": False}
_SIGNS = set("".join(MARKS))
_ADDRESS = re.compile(r"https?://[^\s<>\]]+")
_BRACKETS = re.compile(r"(!?)\[([^\]\n]+)\]\(([^)\n]+)\)")
_TAG = re.compile(r"<[^<>\n]+>")


def _spans(line: str) -> list[str]:
    """Addresses whole, all else by characters; links are their text and their address, images their text, tags nothing."""
    out: list[str] = []
    at = 0
    while at < len(line):
        if m := _ADDRESS.match(line, at):
            out.append(m[0])
        elif m := _BRACKETS.match(line, at):
            out += _spans(m[2]) if m[1] else [*_spans(m[2]), " ", *_spans(m[3])]
        elif m := _TAG.match(line, at):
            pass
        else:
            out.append(line[at])
            at += 1
            continue
        at = m.end()
    return out


def _word(span: str) -> bool:
    return span[-1].isalnum() or span[-1] == "_"


def _unmarked(spans: list[str], mark: str, edges: bool) -> list[str]:
    """Without the marks that pair: the first that may open and the next that may close it, with something between."""
    size, signs = len(mark), list(mark)
    places = [i for i in range(len(spans) - size + 1) if spans[i : i + size] == signs]
    gone: set[int] = set()
    k = 0
    while k < len(places):
        i = places[k]
        opens = not edges or ((i == 0 or not _word(spans[i - 1])) and i + size < len(spans) and not spans[i + size].isspace())
        end = None
        if opens:
            for n in range(k + 1, len(places)):
                j = places[n]
                closes = not edges or (not spans[j - 1].isspace() and (j + size == len(spans) or not _word(spans[j + size])))
                if j > i + size and closes:
                    end = n
                    break
        if end is None:
            k += 1
            continue
        j = places[end]
        gone |= {*range(i, i + size), *range(j, j + size)}
        k = next((n for n in range(end, len(places)) if places[n] >= j + size), len(places))
    return [x for i, x in enumerate(spans) if i not in gone] if gone else spans


def _line(line: str) -> str:
    """One line without what marks it as a quotation or heading; a line of three or more - or * is a rule and left empty."""
    body = line.rstrip(" \t")
    if len(body) >= 3 and set(body) <= {"-", "*"}:
        return ""
    if line.startswith(">"):
        line = line[1:].lstrip(" \t")
    if line.startswith("#"):
        line = line.lstrip("#").lstrip(" \t")
    if _SIGNS.isdisjoint(line) and "[" not in line and "<" not in line:
        return line
    spans = _spans(line)
    for mark, edges in MARKS.items():
        spans = _unmarked(spans, mark, edges)
    return "".join(spans)


def plain_text(text: str) -> str:
    """TX-12: the text that is read: no marks, tags or rules, links with their address behind, at most one empty line in a row.

    Addresses stay as they are, also with underscores or stars in them, and marks around them are paired all the same."""
    out: list[str] = []
    for line in map(_line, text.split("\n")):
        if line or not (len(out) > 1 and not out[-1]):
            out.append(line)
    return "\n".join(out).strip(" \t\n")


@F.pandas_udf(T.StringType())
def plain(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: None if x is None else plain_text(x))
