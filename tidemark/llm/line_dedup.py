"""Fuzzy line dedup by MinHash, in DataFrame functions only.

A line's signature is of all its runs of SHINGLE characters, in any script: each shingle's hash has a bin, and the least
hash of each of the BANDS * ROWS bins is kept (one-permutation MinHash; of long lines only hashes under a bound are
looked at, which leaves one bin in exp(SPREAD) empty). ROWS bins are a band. Copies of a line merge as soon as they are
in one task, so that signatures are shuffled and not texts. Texts are read once more for each verification, of the lines
of its pairs alone.

Lines that share a band are candidates. Each is first compared with one line of its band, in an order of the band's own,
and verified pairs are joined by a distributed union-find. A band whose lines are then of several components is open: all
its lines outside its largest component are compared with all of other components, in blocks of GROUP by GROUP lines,
whatever their number; none is cut off. Two tests drop most unlike pairs inside that join, so that what it makes is near
the number of similar pairs: sketches of SKETCH_BITS bits a bin (LEAST_BINS is so low that all similar ones pass but
one in some thousand), and maps, of MAP_WORDS * 64 parities of the shingles that fall there. Shingles that both lines have change
both maps alike, so maps differ in no more bits than sets in shingles, and no similar pair fails that test; only lines
with a sketch like another's get a map. First ROUNDS further lines of each open band are compared with all others, which
leaves few components of many near copies. Of what passes then, the nearest pair of each two components is verified first by the
exact Jaccard similarity of the sets of shingles, then all pairs whose components that hasn't joined. Of each component,
equal lines included, the line that comes first (by doc_id, then place) is kept.

Equal lines are one from the start. Lines of under LEAST characters (trimmed) are compared for equality alone; lines
without a word stay.

Cases: a null or empty text has no lines to lose; a null one stays null with keep=True. A null doc_id comes last and stays null. Rows with one doc_id and one
text are one document and get the same result. An empty table gives no row. Other columns are kept by
`without_lines(..., keep=True)` and ignored otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import NO_ID, cut, partitions

SHINGLE, LEAST = 5, 25
BANDS, ROWS = 6, 4
SIMILARITY = 0.8
#: Shingles under the bound that a bin of a long line is expected to have.
SPREAD = 3
#: Bits of each bin in a sketch, and bins in one of its words.
SKETCH_BITS, WORD_BINS = 5, 12
#: Bins in which the sketches of a pair agree at least; those of similar lines agree in 19 of 24 on average.
LEAST_BINS = 13
#: Further stars that a band's lines are compared with before all of them meet.
ROUNDS = 2
#: Lines of an open band on either side of a block.
GROUP = 4096
#: Words of 64 bits in a line's map of its distinct shingles.
MAP_WORDS = 16
#: Bytes up to which hashes or places of lines are broadcast; beyond, they are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
_BINS = BANDS * ROWS
_SKETCH = [f"sketch{i}" for i in range(-(-_BINS // WORD_BINS))]
#: A hash's upper bits choose its bin, these are its value; the upper half of the value is kept.
_VALUE_BITS = 48
_VALUE = (1 << _VALUE_BITS) - 1
_KEPT_BITS = 32
_BLANKS = " \t\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _line(line: Column) -> Column:
    blank = reduce(Column.__or__, [at(line, F.lit(c)) for c in _BLANKS for at in (F.startswith, F.endswith)])
    return F.when(blank, F.btrim(line, F.lit(_BLANKS))).otherwise(line)  # few lines need it, and it walks through all characters


def signatures(lines: DataFrame) -> DataFrame:
    """h, keys, sketch0, sketch1 of each distinct line of (h, line), copies included.

    A key is of a band's least hashes; a band with fewer than two filled bins has none. The sketch has SKETCH_BITS of each bin.
    """
    wide = lines.select("h", F.encode("line", "UTF-32").alias("u"))  # four bytes for each character, so that a slice takes no walk
    wide = wide.select("h", "u", (F.shiftright(F.length("u"), 2) - (SHINGLE - 1)).alias("n")).where("n > 0")
    bound = (F.least(F.lit(1.0), F.lit(float(SPREAD * _BINS)) / F.col("n")) * float(_VALUE)).cast("long")
    places = wide.select("h", bound.alias("bound"), "u", F.explode(F.sequence(F.lit(1), F.col("n") * 4, F.lit(4))).alias("at"))
    s = places.select("h", "bound", F.xxhash64(F.substring("u", F.col("at"), F.lit(4 * SHINGLE))).alias("s"))
    s = s.where(F.col("s").bitwiseAND(F.lit(_VALUE)) <= F.col("bound"))
    value = F.shiftright(F.col("s").bitwiseAND(F.lit(_VALUE)), _VALUE_BITS - _KEPT_BITS)
    s = s.select("h", (F.shiftrightunsigned("s", _VALUE_BITS) % _BINS).cast("int").alias("bin"), value.alias("v"))
    bins = [f"m{i}" for i in range(_BINS)]
    least = s.groupBy("h").agg(*[F.expr(f"min(v) filter (where bin = {i})").alias(m) for i, m in enumerate(bins)])  # a filter leaves the other bins untouched
    bands = [bins[i : i + ROWS] for i in range(0, _BINS, ROWS)]
    filled = lambda of: sum((F.col(m).isNotNull().cast("int") for m in of), F.lit(0))
    keys = F.array_compact(F.array(*[F.when(filled(of) > 1, F.xxhash64(F.lit(i), *of)) for i, of in enumerate(bands)]))
    bits = [F.shiftleft(F.coalesce(F.col(m), F.lit(0)).bitwiseAND(F.lit((1 << SKETCH_BITS) - 1)).cast("long"), SKETCH_BITS * (i % WORD_BINS)) for i, m in enumerate(bins)]
    words = [reduce(Column.bitwiseOR, bits[i * WORD_BINS : (i + 1) * WORD_BINS]).alias(c) for i, c in enumerate(_SKETCH)]
    return least.select("h", keys.alias("keys"), *words)


def _alike(a: str, b: str) -> Column:
    """Whether two sketches, with these endings of their columns, agree in LEAST_BINS bins."""
    firsts = F.lit(sum(1 << SKETCH_BITS * i for i in range(WORD_BINS)))
    unlike = lambda x: F.bit_count(reduce(Column.bitwiseOR, [F.shiftrightunsigned(x, i) for i in range(SKETCH_BITS)]).bitwiseAND(firsts))
    return sum((unlike(F.col(c + a).bitwiseXOR(F.col(c + b))) for c in _SKETCH), F.lit(0)) <= _BINS - LEAST_BINS


def _exploded(docs: DataFrame) -> DataFrame:
    """_id, _uid, no, line of every line with a word."""
    rows = docs.select("_id", "_uid", F.posexplode(_lines(F.col("_text"))).alias("no", "line"))
    return rows.select("_id", "_uid", "no", _line(F.col("line")).alias("line")).where("line <> ''")


def _bounded(df: DataFrame, size: Column) -> DataFrame:
    """df, to be broadcast if its rows of `size` bytes are few enough; it is checkpointed, so summing is cheap."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def _shingle_set(line: Column) -> Column:
    """Hashes of the distinct runs of SHINGLE characters of a line that has one."""
    of = lambda u: F.transform(F.sequence(F.lit(1), F.length(u) - (4 * SHINGLE - 1), F.lit(4)), lambda at: F.xxhash64(F.substring(u, at, F.lit(4 * SHINGLE))))
    return F.transform(F.array(F.encode(line, "UTF-32")), lambda u: F.array_distinct(of(u)))[0]


def _texts(asked: DataFrame, lines: DataFrame) -> DataFrame:
    """h, line of the hashes asked for, each once; lines: (h, line), copies included."""
    return lines.join(_bounded(asked, F.lit(64)), "h").groupBy("h").agg(F.first("line").alias("line"))


def _maps(texts: DataFrame) -> DataFrame:
    """h, n, w0, w1, ...: the number of a line's distinct shingles, and for each bit whether an odd number of them falls there."""
    sets = texts.select("h", _shingle_set(F.col("line")).alias("s"))
    s = sets.select("h", F.size("s").alias("n"), F.explode("s").alias("s"))
    s = s.select("h", "n", F.expr(f"cast(shiftright(s, 6) & {MAP_WORDS - 1} as int)").alias("word"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("bit"))
    return s.groupBy("h", "n").agg(*[F.expr(f"coalesce(bit_xor(bit) filter (where word = {i}), 0)").alias(f"w{i}") for i in range(MAP_WORDS)])


def _differ(a: str, b: str) -> Column:
    """Bits in which the maps of two lines differ, with these endings of their columns."""
    return sum((F.bit_count(F.col(f"w{i}{a}").bitwiseXOR(F.col(f"w{i}{b}"))) for i in range(MAP_WORDS)), F.lit(0))


def _near(a: str, b: str) -> Column:
    """Whether the maps of two lines differ in no more bits than those of similar lines may."""
    return _differ(a, b) * (1 + SIMILARITY) <= (F.col(f"n{a}") + F.col(f"n{b}")) * (1 - SIMILARITY) + 1e-9


def _ended(df: DataFrame, end: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{c}{end}") for c in df.columns])


def verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """a, b of the pairs (a, b) of an exact Jaccard similarity of SIMILARITY or more; lines: (h, line), copies included.

    The texts travel, which are an eighth of their sets, and each pair makes its own sets.
    """
    found = cut(_texts(cut(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()), lines))
    two = _bounded(pairs, F.lit(64))
    sides = [found.withColumnRenamed("h", c).join(two, c).select("a", "b", F.col("line").alias(f"line_{c}")) for c in "ab"]
    both = sides[0].join(sides[1], ["a", "b"])  # by pairs, so that no line in many of them is one task's
    sets_of = both.select("a", "b", _shingle_set(F.col("line_a")).alias("s_a"), _shingle_set(F.col("line_b")).alias("s_b"))
    common, n = F.size(F.array_intersect("s_a", "s_b")), F.size("s_a") + F.size("s_b")
    return sets_of.select("a", "b", (common * (1 + SIMILARITY) >= SIMILARITY * n - 1e-9).alias("similar")).where("similar").select("a", "b")


def _pair(g: str, h: str) -> list[Column]:
    return [F.least(g, h).alias("a"), F.greatest(g, h).alias("b")]


def _met(groups: DataFrame, keys: DataFrame) -> DataFrame:
    """The lines (key, h, sketch, ...) of keys that two or more (n) have, with the star g and its sketch (ending in _of): one line of the key.

    Each key has an order of its own, the hash exclusive-or the key, and the least is the star. Keys of one line, which
    most are, go no further than a partly summed count.
    """
    least = groups.groupBy("key").agg(F.count("*").alias("n"), F.min(F.col("h").bitwiseXOR(F.col("key"))).alias("x")).where("n > 1")
    least = least.select("key", "n", F.col("x").bitwiseXOR(F.col("key")).alias("g"))
    least = cut(least.join(keys.select(F.col("h").alias("g"), *[F.col(c).alias(f"{c}_of") for c in _SKETCH]), "g"))
    return groups.join(_bounded(least, F.lit(64)), "key")


def _stars(met: DataFrame) -> DataFrame:
    """a, b: each line with its key's star, where their sketches agree."""
    return met.where((F.col("g") != F.col("h")) & _alike("", "_of")).select(*_pair("g", "h"))


def _starred(still: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines of open keys (key, h, root, and their map) with the roots that more stars leave, and the links a, b found.

    In each of ROUNDS rounds a key has another of its lines as its star, and the nearest pair of each component and the
    star's is verified. So a key's near copies, which one star doesn't all reach, are mostly one component before all its
    lines meet, at the cost of one pair a line.
    """
    links = texts.where("false").select(F.col("h").alias("a"), F.col("h").alias("b"))
    for k in range(ROUNDS):
        order = F.xxhash64(F.lit(3 + k), "h", "key")
        of = [c for c in still.columns if c in ("h", "n", "root") or c.startswith("w")]
        stars = still.groupBy("key").agg(F.min_by(F.struct(*[F.col(c).alias(f"{c}_1") for c in of]), order).alias("star"), F.min("root").alias("least"), F.max("root").alias("most"))
        stars = cut(stars.where("least <> most").select("key", "star.*"))
        met = _ended(still.select("key", *of), "_2").join(_bounded(stars, F.lit(256)), F.col("key_2") == F.col("key")).where((F.col("root_1") != F.col("root_2")) & _near("_1", "_2"))
        far = _differ("_1", "_2") / (F.col("n_1") + F.col("n_2"))
        met = met.select(*_pair("h_1", "h_2"), F.least("root_1", "root_2").alias("u"), F.greatest("root_1", "root_2").alias("v"), far.alias("far"))
        best = cut(met.groupBy("u", "v").agg(F.min_by(F.struct("a", "b"), "far").alias("p")).select("u", "v", "p.*"))
        found = cut(verified(best.select("a", "b"), texts))
        to = cut(components(best.join(_bounded(found, F.lit(64)), ["a", "b"], "left_semi"), "u", "v"))
        for c in ("root", "main"):
            new = _bounded(to.select(F.col("node").alias(c), F.col("root").alias("_to")), F.lit(64))
            still = still.join(new, c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")
        still, links = cut(still), links.union(found)
    return still, links


def _across(groups: DataFrame, lines: DataFrame) -> DataFrame:
    """a, b: links between components of lines of one key (key, h, sketch, root); lines: (h, line), copies included.

    A key's lines outside its largest component meet all of its lines of other components. Both are dealt to stripes of
    some GROUP lines, and a block is the meeting of two stripes. Two components need one link, so of the pairs that may
    be similar the nearest of each two is verified first, and the others only where those links don't join them.
    """
    parts = groups.groupBy("key", "root").agg(F.count("*").alias("c"))
    most = parts.groupBy("key").agg(F.sum("c").alias("all"), F.max(F.struct("c", "root")).alias("most"), F.count("*").alias("roots")).where("roots > 1 and `all` > 2")
    split = most.select("key", F.col("most.root").alias("main"), F.ceil(F.col("all") / GROUP).alias("cols"), F.ceil((F.col("all") - F.col("most.c")) / GROUP).alias("rows"))
    still = cut(groups.join(_bounded(cut(split), F.lit(64)), "key").withColumn("at", F.xxhash64(F.lit(2), "h")))
    to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    block = [F.col(f"{c}_1") == F.col(f"{c}_2") for c in ("key", "row", "col")]
    other = (F.col("root_1") != F.col("root_2")) & ((F.col("root_2") == F.col("main_2")) | (F.col("root_1") < F.col("root_2")))

    def dealt(of: DataFrame) -> tuple[DataFrame, DataFrame]:
        few = of.where("root <> main").withColumn("row", F.pmod("at", "rows")).withColumn("col", to("cols"))
        all_ = of.withColumn("col", F.pmod("at", "cols")).withColumn("row", to("rows"))
        return _ended(few.drop("at", "rows", "cols"), "_1"), _ended(all_.drop("at", "rows", "cols"), "_2")

    few, all_ = dealt(still)
    alike = reduce(Column.__and__, [*block, other, _alike("_1", "_2")])
    asked = few.join(all_, alike, "left_semi").select(F.col("h_1").alias("h")).union(all_.join(few, alike, "left_semi").select("h_2"))
    texts = cut(_texts(cut(asked.distinct()), lines))
    still, links = _starred(cut(still.join(cut(_maps(texts)), "h")), texts)
    few, all_ = dealt(still)
    far = _differ("_1", "_2") / (F.col("n_1") + F.col("n_2"))
    pairs = few.join(all_, alike & _near("_1", "_2")).select(*_pair("h_1", "h_2"), F.least("root_1", "root_2").alias("u"), F.greatest("root_1", "root_2").alias("v"), far.alias("far"))
    pairs = cut(pairs.distinct())
    best = cut(pairs.groupBy("u", "v").agg(F.min_by(F.struct("a", "b"), "far").alias("p")).select("u", "v", "p.*"))
    found = cut(verified(best.select("a", "b"), texts))
    links = links.union(found)
    joined = cut(components(best.join(_bounded(found, F.lit(64)), ["a", "b"], "left_semi"), "u", "v"))
    rest = pairs.select("a", "b", "u", "v")
    for c in "uv":
        to = _bounded(joined.select(F.col("node").alias(c), F.col("root").alias(f"to_{c}")), F.lit(64))
        rest = rest.join(to, c, "left").withColumn(f"to_{c}", F.coalesce(f"to_{c}", c))
    rest = rest.where("to_u <> to_v").join(_bounded(best.select("a", "b"), F.lit(64)), ["a", "b"], "left_anti").select("a", "b")
    return links.union(verified(cut(rest), texts))


def fuzzy_links(lines: DataFrame) -> DataFrame:
    """a, b: hashes of distinct lines, joined by verified similarities; lines: (h, line), copies included."""
    keys = cut(signatures(lines))
    groups = cut(_met(keys.select("h", *_SKETCH, F.explode("keys").alias("key")), keys))
    first = cut(_stars(groups).distinct())
    roots = cut(components(verified(first, lines)))
    links = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    groups = groups.where("n > 2")  # of two lines one is the star
    groups = groups.join(_bounded(roots.withColumnRenamed("node", "h"), F.lit(64)), "h", "left").select("key", "h", *_SKETCH, F.coalesce("root", "h").alias("root"))
    return links.union(_across(groups, lines))


def lost_lines(docs: DataFrame) -> DataFrame:
    """_uid, lost: the places of lines that go, of documents (_id, _uid, _text) that lose any."""
    lines = cut(_exploded(docs).select("_id", "_uid", "no", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2")))
    place = F.struct("_id", "_uid", "no")
    texts = _exploded(docs).where(F.length("line") >= LEAST).select(F.xxhash64("line").alias("h"), "line")
    roots = cut(components(fuzzy_links(texts)).select(F.col("node").alias("h"), "root"))
    member = cut(roots.union(roots.select(F.col("root"), "root")).distinct())
    first = lines.groupBy("h", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    kept = cut(first.join(_bounded(member, F.lit(64)), "h", "left").where("n > 1 or root is not null"))  # all others stay
    by_root = kept.where("root is not null").groupBy("root").agg(F.min("first").alias("kept"))
    kept = cut(kept.join(by_root, "root", "left").select("h", "h2", F.coalesce("kept", "first").alias("kept")))
    lost = lines.join(_bounded(kept, F.lit(160)), ["h", "h2"]).where(place != F.col("kept"))
    return cut(lost.groupBy("_uid").agg(F.collect_set("no").alias("lost")))


def without_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """doc_id, n_lines, n_removed, text (the lines left); with keep: docs, with that text and without the counts."""
    docs.sparkSession.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")  # what is checkpointed needs no shuffle files
    row = F.struct("*") if keep else F.struct(docs[id_col].alias("doc_id"))
    named = docs.select(row.alias("_row"), F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_text"))
    named = named.withColumn("_uid", F.xxhash64("_id", "_text"))
    lost = _bounded(lost_lines(named.select("_id", "_uid", "_text")), F.lit(64) + 8 * F.size("lost"))
    out = named.join(lost, "_uid", "left")

    def left(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("lost"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    text = F.when(F.col("lost").isNotNull(), F.transform(F.array(_lines(F.col("_text"))), left)[0])
    if keep:
        text = F.coalesce(text, F.col("_row").getField(text_col))
        return out.select(F.col("_row").withField(f"`{text_col}`", text).alias("_row")).select("_row.*")
    text = F.coalesce(text, F.col("_text"))
    n_lines = F.size(_lines(F.col("_text"))).cast("long")
    return out.select("_row.doc_id", n_lines.alias("n_lines"), F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_removed"), text.alias("text"))


def dedup_lines(docs: DataFrame, **more) -> DataFrame:
    """without_lines with the digest of the text."""
    return without_lines(docs, **more).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
