"""Texts cut to a channel's size."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F


def _prefix(text: str, most: int) -> str:
    return text.encode()[:most].decode(errors="ignore")


def _units(text: str, most: int) -> Iterator[tuple[str, str]]:
    """(what joins it to the unit before, unit): paragraphs, and the lines of those that are too long."""
    for paragraph in text.split("\n\n"):
        if len(paragraph.encode()) <= most:
            yield "\n\n", paragraph
        else:
            first, *rest = paragraph.split("\n")
            yield "", first
            yield from (("\n", x) for x in rest)


def split_text(text: str, most: int) -> list[str]:
    """RP-10: parts of at most `most` UTF-8 bytes, cut between paragraphs, else lines, else characters."""
    if most < 4 or len(text.encode()) <= most:
        return [text]
    out, held = [], ""
    for joint, unit in _units(text, most):
        if held and joint and len((held + joint + unit).encode()) <= most:
            held += joint + unit
            continue
        if held:
            out.append(held)
        while len(unit.encode()) > most:
            out.append(_prefix(unit, most))
            unit = unit[len(out[-1]) :]
        held = unit
    return [*out, held] if held else out or [text]


def split_column(most: int):
    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: split_text(x or "", most))

    return run


def split_lines(text: str, most: int, head: str = "") -> list[str]:
    """RP-9: parts of at most `most` UTF-8 bytes with all that the text has: cut after lines, and inside those that are longer.

    Every part but the first begins with head once more, unless that takes over half of a part."""
    head = head if 2 * len(head.encode()) <= most else ""
    out, held, own = [], "", False
    for line in re.findall(r"[^\n]*\n|[^\n]+", text):
        while len((held + line).encode()) > most:
            if not own:  # a line that a part of its own doesn't hold
                piece = _prefix(line, most - len(held.encode()))
                held, line = held + piece, line[len(piece) :]
            out.append(held)
            held, own = head, False
        held, own = held + line, own or bool(line)
    return [*out, held] if own else out


def lines_within(most: int):
    """split_lines of columns of texts and heads; null where the text is."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series, heads: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else split_lines(x, most, h) for x, h in zip(texts, heads, strict=True)])

    return run
