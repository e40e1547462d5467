import random

from pyspark.sql import functions as F

from tidemark.llm import line_dedup
from tidemark.llm.components import components


def _near_copies():
    """Copies of one line with edits of their own, so that many of them are far from each other and from any one star."""
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(240))
    out = set()
    for _ in range(90):
        x = list(base)
        for at in rng.sample(range(len(x)), rng.randrange(1, 6)):
            x[at] = rng.choice("0123456789")
        out.add("".join(x))
    return sorted(out)


def test_further_stars_leave_fewer_pairs_and_the_same_components(spark, monkeypatch):
    lines = spark.createDataFrame([(x,) for x in _near_copies()], "line string").selectExpr("xxhash64(line) as h", "line")
    met, cut = [], line_dedup.cut

    def counted(df):
        out = cut(df)
        if {"far", "u"} <= set(df.columns):
            met.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "cut", counted)
    found = []
    for rounds in (0, line_dedup.ROUNDS):
        monkeypatch.setattr(line_dedup, "ROUNDS", rounds)
        found.append({tuple(r) for r in components(line_dedup.fuzzy_links(lines)).collect()})
    assert found[0] == found[1] and len(found[0]) > 60
    assert met[0] > 0 and met[1] <= met[0] / 2


def test_sketches_drop_unlike_lines_of_one_band(spark):
    """Of pairs that share a band but a quarter of their shingles, few pass the sketches; of similar ones all do."""
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    common = letters(110)
    rows = [(i, common + letters(130)) for i in range(400)]
    for i in range(200):
        base = letters(240)
        rows += [(1000 + 2 * i, base), (1001 + 2 * i, f"{base[:100]}0{base[101:180]}0{base[181:]}")]
    signed = line_dedup.signatures(spark.createDataFrame(rows, "h long, line string"))
    keyed = signed.select("*", F.explode("keys").alias("key"))
    met = line_dedup._ended(keyed, "_1").join(line_dedup._ended(keyed, "_2"), F.expr("key_1 = key_2 and h_1 < h_2")).withColumn("alike", line_dedup._alike("_1", "_2"))
    of = {r.similar: r for r in met.groupBy((F.col("h_1") >= 1000).alias("similar")).agg(F.count_distinct("h_1", "h_2").alias("n"), F.count_distinct(F.when(F.col("alike"), F.struct("h_1", "h_2"))).alias("pass")).collect()}
    assert of[False].n > 500 and of[False]["pass"] < 0.15 * of[False].n
    assert of[True].n > 190 and of[True]["pass"] == of[True].n
