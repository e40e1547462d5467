"""Keyword rules: the text form, and its compilation to one CASE expression.

Groups are divided by blank lines. A line is a word, or starts with + (required), ! (excluded everywhere), @ (at most so
many of the group), [ (the group's name) or # (a comment); /.../ is a regular expression; `=> name` names a word's group.
Words under [GLOBAL_FILTER] reject a title; [WORD_GROUPS] ends that section.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import matches


@dataclass(frozen=True)
class Word:
    text: str
    regex: bool = False


@dataclass
class Group:
    name: str = ""
    required: list[Word] = field(default_factory=list)
    normal: list[Word] = field(default_factory=list)
    most: int = 0


@dataclass
class Rules:
    groups: list[Group] = field(default_factory=list)
    excluded: list[Word] = field(default_factory=list)
    filters: list[str] = field(default_factory=list)


def _word(text: str) -> tuple[Word, str]:
    text, _, alias = (x.strip() for x in text.partition("=>"))
    if m := re.fullmatch(r"/(.*)/[a-z]*", text):
        return Word(m[1], True), alias
    return Word(text.lower()), alias


def parse(source: str) -> Rules:
    rules, section = Rules(), "[WORD_GROUPS]"
    for block in re.split(r"\n[ \t]*\n", source.strip()):
        group = Group()
        for line in filter(None, map(str.strip, block.split("\n"))):
            if line[0] == "#":
                continue
            if line.upper() in ("[GLOBAL_FILTER]", "[WORD_GROUPS]"):
                section = line.upper()
            elif section == "[GLOBAL_FILTER]":
                rules.filters.append(line.lower())
            elif line[0] == "[" and line[-1] == "]":
                group.name = line[1:-1].strip()
            elif line[0] == "@" and line[1:].strip().isdigit():
                group.most = int(line[1:])
            elif line[0] == "!":
                rules.excluded.append(_word(line[1:])[0])
            else:
                word, alias = _word(line.lstrip("+"))
                (group.required if line[0] == "+" else group.normal).append(word)
                group.name = group.name or alias
        if group.required or group.normal:
            group.name = group.name or " ".join(w.text for w in group.required + group.normal)
            rules.groups.append(group)
    return rules


def _all(columns: list[Column], use, start: bool) -> Column:
    out = F.lit(start)
    for c in columns:
        out = use(out, c)
    return out


def rejected(rules: Rules, title: Column) -> Column:
    """Blank, filtered or excluded."""
    return _all([F.contains(F.lower(title), F.lit(x)) for x in rules.filters] + [matches(title, w.text, w.regex) for w in rules.excluded], lambda a, b: a | b, False) | (F.trim(title) == "")


def group_of(rules: Rules, title: Column, position: bool = False) -> Column:
    """TX-3, JN-14: the first group whose required words all match and, if it has normal words, one of them; else null."""
    out = F.when(rejected(rules, title), None)
    for i, g in enumerate(rules.groups):
        hit = _all([matches(title, w.text, w.regex) for w in g.required], lambda a, b: a & b, True)
        if g.normal:
            hit = hit & _all([matches(title, w.text, w.regex) for w in g.normal], lambda a, b: a | b, False)
        out = out.when(hit, F.lit(i) if position else F.lit(g.name))
    return out


def any_group_of(rules: Rules, title: Column) -> Column:
    """AG-14: the first group of which any word matches, without filters."""
    out = None
    for g in rules.groups:
        hit = _all([matches(title, w.text, w.regex) for w in g.required + g.normal], lambda a, b: a | b, False)
        out = F.when(hit, F.lit(g.name)) if out is None else out.when(hit, F.lit(g.name))
    return out


def sql(rules: Rules, title: str = "title") -> str:
    """group_of in SQL, by position."""
    one = lambda w: f"regexp_matches(lower({title}), '(?i){w.text}')" if w.regex else f"contains(lower({title}), '{w.text}')"
    no = " OR ".join([f"contains(lower({title}), '{x}')" for x in rules.filters] + [one(w) for w in rules.excluded] + [f"trim({title}) = ''"])
    cases = []
    for i, g in enumerate(rules.groups):
        parts = [one(w) for w in g.required] + ([f"({' OR '.join(map(one, g.normal))})"] if g.normal else [])
        cases.append(f"WHEN {' AND '.join(parts)} THEN {i}")
    return f"CASE WHEN {no} THEN NULL {' '.join(cases)} END"


def any_sql(rules: Rules, title: str = "title") -> str:
    one = lambda w: f"regexp_matches(lower({title}), '(?i){w.text}')" if w.regex else f"contains(lower({title}), '{w.text}')"
    return "CASE " + " ".join(f"WHEN {' OR '.join(map(one, g.required + g.normal))} THEN '{g.name}'" for g in rules.groups) + " END"


#: Rules over the frequent syllables of the test data's prose.
SAMPLE = """
[GLOBAL_FILTER]
!!
$$$

[WORD_GROUPS]
[Attain]
+the
tion
nd
@5

# French
eau
ment
@3

sch => German
ein

/ci[oó]n/ => Spanish
mente

[Rest]
ing
er
!sponsored
!ererer
"""
RULES = parse(SAMPLE)
