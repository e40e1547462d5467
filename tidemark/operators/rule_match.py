"""Large sets of rules against titles: words are found by a multi-pattern automaton, and groups are decided by the words found.

Rules are a table: position (of the group), role ('required', 'normal', 'excluded' or 'filter') and word. They are sent to all tasks
in parts of at most PART characters, whole groups together, so what a task holds is bounded however many there are; the
answer is the first position of all parts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of words, with ten for each word, that one automaton is made of.
PART = 16 << 20
ROLES = ("required", "normal", "excluded", "filter")


class Matcher:
    """Groups, as (position, required words, normal words), and words that reject a title."""

    def __init__(self, groups: Iterable[tuple[int, list[str], list[str]]], rejecting: Iterable[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.rejecting = {x for x in rejecting}
        #: By word: groups in which it is required, and groups in which it is one of the normal words.
        self.required: dict[str, list[int]] = {}
        self.normal: dict[str, list[int]] = {}
        self.groups = []
        for k, (position, required, normal) in enumerate(sorted(groups)):
            required, normal = {*required}, {*normal}
            self.groups.append((position, len(required), bool(normal)))
            for of, words in ((self.required, required), (self.normal, normal)):
                for w in words:
                    of.setdefault(w, []).append(k)
        for w in {*self.rejecting, *self.required, *self.normal}:
            self.automaton.add_word(w, w)
        if len(self.automaton):
            self.automaton.make_automaton()

    def position(self, title: str | None) -> int | None:
        """TX-3: the first group all of whose required words and, if it has normal ones, one of these are in the title."""
        if not title or not title.strip() or not len(self.automaton):
            return None
        found = {w for _, w in self.automaton.iter(title.lower())}
        if not found or not self.rejecting.isdisjoint(found):
            return None
        met: dict[int, int] = {}
        for w in found:
            for k in self.required.get(w, ()):
                met[k] = met.get(k, 0) + 1
        open_ = {k for w in found for k in self.normal.get(w, ())}
        fits = [k for k in {*met, *open_} if met.get(k, 0) == self.groups[k][1] and (not self.groups[k][2] or k in open_)]
        return self.groups[min(fits)][0] if fits else None


def _parts(rules: DataFrame, most: int) -> list[tuple[list[tuple[int, list[str], list[str]]], list[str]]]:
    """Groups in order, in parts of some `most` characters; all rejecting words go with the first part."""
    words = lambda role: F.collect_list(F.when(F.col("role") == role, F.lower("word")))
    rejecting = [r.word for r in rules.where("role in ('excluded', 'filter')").select(F.lower("word").alias("word")).distinct().toLocalIterator()]
    groups = rules.where("role in ('required', 'normal')").groupBy("position").agg(words("required").alias("required"), words("normal").alias("normal")).orderBy("position")
    out, held, size = [], [], 0
    for r in groups.toLocalIterator():
        held.append((r.position, r.required, r.normal))
        size += sum(len(w) + 10 for w in r.required + r.normal)
        if size > most:
            out.append(held)
            held, size = [], 0
    if held or not out:
        out.append(held)
    return [(part, [] if k else rejecting) for k, part in enumerate(out)]


def positions(titles: DataFrame, rules: DataFrame, title: str, name: str = "position", most: int = PART) -> DataFrame:
    """titles with the position of the group that takes each, or null. Words are compared in lower case, as parts of the title."""
    spark = titles.sparkSession
    columns: list[Column] = []
    rejects = None
    for groups, rejecting in _parts(rules, most):
        sent = spark.sparkContext.broadcast((groups, rejecting))  # at most a part
        columns.append(_asked(sent)(F.col(title)))
        rejects = sent if rejects is None else rejects
    if len(columns) == 1:
        return titles.withColumn(name, columns[0])
    out = titles.withColumn("_no", _rejected(rejects)(F.col(title)))
    return out.withColumn(name, F.when(~F.col("_no"), F.least(*columns))).drop("_no")


def _asked(sent):
    @F.pandas_udf("int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Matcher(*sent.value)  # once a task
        for titles in batches:
            yield pd.Series([m.position(x) for x in titles], dtype="Int32")

    return run


def _rejected(sent):
    @F.pandas_udf("boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Matcher([], sent.value[1])
        hit = lambda x: bool(x) and len(m.automaton) > 0 and next(m.automaton.iter(x.lower()), None) is not None
        for titles in batches:
            yield pd.Series([hit(x) for x in titles], dtype="bool")

    return run
