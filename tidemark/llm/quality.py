"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Two base rules reject a document: fewer than 10 words, or over a fifth of its words in 5-word windows that it repeats.
Four scores may reject more: symbols a word, characters a word, repeated lines, repeated words. Their cutoffs are not
given but chosen: for each stratum (language), score and cutoff of a grid that is fixed beforehand, documents labelled
good are a holdout, and with k of n of them rejected the exact binomial probability P(Bin(n, RISK) <= k) tests "this
cutoff falsely rejects more than RISK". The tests are corrected for their number (Bonferroni); of the cutoffs for which
it is refused the lowest is used, none if there is none. So with probability 1 - DOUBT, no cutoff falsely rejects more
than RISK of the good documents of its stratum.

Cases: a null or empty text has no words and fails. A null stratum is one of its own. Labels of null ids or values are
ignored; a document counts as good if it has labels and all say so. A null doc_id stays null; repeated rows are judged
each; empty tables give no row, or no cutoffs. A window's words are compared by a 64-bit hash within the document.
Other columns are kept by `keep_good` and ignored otherwise.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import cut

BLANK = " \t\n\x0b\x0c\r"
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: False rejections allowed to one score, and the doubt allowed to all of them together.
RISK, DOUBT = 0.005, 0.05
GRID = {
    "symbols": (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.6, 0.8, 1.0, 1.5, 2.0),
    "characters": (5.5, 6.0, 6.5, 7.0, 7.5, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0),
    "lines": (0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.8),
    "repeats": (0.1, 0.12, 0.14, 0.16, 0.18),
}
#: Labels, or strata, up to which they are broadcast (16 and 40 bytes each); beyond, they are joined by a shuffle.
BROADCAST_LABELS, BROADCAST_STRATA = 2_000_000, 100_000
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, use) -> Column:
    """use(value), with value computed once: a lambda's variable is bound before its body runs."""
    return F.transform(F.array(value), use)[0]


def _repeated(words: Column) -> Column:
    """Words in windows that the array of words has twice or more."""

    def cover(hashes: Column) -> Column:
        def positions(sorted_: Column) -> Column:
            same = lambda j, k: F.coalesce(F.get(sorted_, j)["h"] == F.get(sorted_, k)["h"], F.lit(False))
            twice = F.filter(F.sequence(F.lit(0), F.size(sorted_) - 1), lambda j: same(j, j - 1) | same(j, j + 1))
            return F.sort_array(F.transform(twice, lambda j: F.get(sorted_, j)["i"]))

        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        step = lambda s, p: F.struct((s["n"] + p + WINDOW - F.greatest(p, s["end"])).alias("n"), (p + WINDOW).alias("end"))
        covered = F.aggregate(_let(placed, positions), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda s: s["n"])
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered).otherwise(0)

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) > WINDOW, _let(hashes, cover)).otherwise(0)


def measures(text: Column) -> Column:
    """A struct of METRICS and n_lines (lines with a word) of a text."""
    text = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANK))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of(w: Column) -> Column:
        return _let(
            lines,
            lambda x: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                _repeated(w).cast("long").alias("n_repeat_words"),
                F.size(x).cast("long").alias("n_lines"),
            ),
        )

    return _let(words, of)


def _base_failed(m: Column) -> Column:
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])


def _scores(m: Column) -> dict[str, Column]:
    ratio = lambda a, b: F.when(m[b] > 0, m[a] / m[b]).otherwise(0.0)
    return {"symbols": ratio("n_symbols", "n_words"), "characters": ratio("word_chars", "n_words"), "lines": ratio("n_dup_lines", "n_lines"), "repeats": ratio("n_repeat_words", "n_words")}


def _at_most(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exactly: each term from the one before; 1 where k is no less than the mean."""
    odds, none = log(p / (1 - p)), log(1 - p)
    first = n * F.lit(none)
    step = lambda s, j: F.struct((s["t"] + F.log((n - j) / (j + 1)) + F.lit(odds)).alias("t"), (s["sum"] + F.exp(s["t"] + F.log((n - j) / (j + 1)) + F.lit(odds))).alias("sum"))
    upto = F.when(k > 0, F.sequence(F.lit(0).cast("long"), k - 1)).otherwise(F.array().cast("array<long>"))
    return F.when(k < n * p, F.aggregate(upto, F.struct(first.alias("t"), F.exp(first).alias("sum")), step, lambda s: s["sum"])).otherwise(1.0)


def cutoffs(docs: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text", risk: float = RISK, doubt: float = DOUBT, grid: dict | None = None) -> tuple[DataFrame, int]:
    """(_stratum, and a column of each score: its cutoff or null), and the number of strata."""
    grid = GRID if grid is None else grid
    good = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select(F.col("doc_id").cast("long").alias("_id"))
    if labels.count() <= BROADCAST_LABELS:
        good = F.broadcast(good)
    named = docs.select(docs[id_col].cast("long").alias("_id"), F.coalesce(docs[stratum].cast("string"), F.lit("\0")).alias("_stratum"), docs[text_col].alias("_text"))
    held = named.join(good, "_id").select("_stratum", measures(F.col("_text")).alias("m"))
    # counted by condition: a filter would be pushed below the measures and compute them anew
    scored = held.select("_stratum", (~_base_failed(F.col("m"))).alias("ok"), *[c.alias(name) for name, c in _scores(F.col("m")).items()])
    cells = [(name, x) for name, xs in grid.items() for x in xs]
    counted = scored.groupBy("_stratum").agg(F.count_if("ok").alias("n"), *[F.count_if(F.col("ok") & (F.col(name) > x)).alias(f"k{i}") for i, (name, x) in enumerate(cells)]).where("n > 0")
    rows = counted.select("_stratum", "n", F.explode(F.array(*[F.struct(F.lit(name).alias("score"), F.lit(x).alias("cutoff"), F.col(f"k{i}").alias("k")) for i, (name, x) in enumerate(cells)])).alias("cell"))
    rows = cut(rows)
    n_strata = rows.count() // max(1, len(cells))
    passed = rows.where(_at_most(F.col("n"), F.col("cell.k"), risk) <= doubt / max(1, n_strata * len(cells)))
    chosen = passed.groupBy("_stratum").agg(*[F.min(F.when(F.col("cell.score") == name, F.col("cell.cutoff"))).alias(f"_cut_{name}") for name in grid])
    return chosen, n_strata


def _judged(docs: DataFrame, labels: DataFrame, stratum: str, id_col: str, text_col: str, whole: bool, **more) -> DataFrame:
    """_row (a struct of doc_id, or of the whole row), _m (the measures), _failed, _kept. Names inside _row can't clash."""
    chosen, n_strata = cutoffs(docs, labels, stratum, id_col, text_col, **more)
    if n_strata <= BROADCAST_STRATA:
        chosen = F.broadcast(chosen)
    kept = F.struct("*") if whole else F.struct(docs[id_col].alias("doc_id"))
    out = docs.select(kept.alias("_row"), F.coalesce(docs[stratum].cast("string"), F.lit("\0")).alias("_stratum"), measures(docs[text_col]).alias("_m"))
    out = out.join(chosen, "_stratum", "left").withColumn("_failed", _base_failed(F.col("_m")))
    over = [F.coalesce(c > F.col(f"_cut_{name}"), F.lit(False)) for name, c in _scores(F.col("_m")).items()]
    rejected = F.lit(False)
    for x in over:
        rejected = rejected | x
    # one condition over both sides of the join: a part of it alone would be pushed below the measures and compute them anew
    return out.withColumn("_kept", F.when(F.col("_failed"), F.lit(False)).otherwise(~rejected))


def quality(docs: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """doc_id, METRICS, base_failed, kept."""
    out = _judged(docs, labels, stratum, id_col, text_col, False, **more)
    return out.select("_row.doc_id", *[F.col(f"_m.{x}").alias(x) for x in METRICS], F.col("_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns."""
    return _judged(docs, labels, stratum, id_col, text_col, True, **more).where("_kept").select("_row.*")
