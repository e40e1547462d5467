import random
import re
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions import scores, text, urls
from tidemark.operators import blocks, history, rounds, similarity
from tidemark.operators.delivery import packed


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


def test_weight(spark):
    assert one(spark, [1, 3], lambda c: F.round(scores.weight(c, F.lit(4)), 6), "array<int>") == round(0.6 * 90 + 0.3 * 40 + 0.1 * 100, 6)
    assert one(spark, [], lambda c: scores.weight(c, F.lit(4)), "array<int>") == 0


def test_normalize_url(spark):
    assert one(spark, "https://a/b?z=1&UTM_source=x&a=2#f", urls.normalize_url) == "https://a/b?a=2&z=1"
    assert one(spark, "https://a/b#f", urls.normalize_url) == "https://a/b#f"
    assert one(spark, "https://a/b?ref=1", urls.normalize_url) == "https://a/b"
    assert one(spark, "https://a/articles/story-ecb497c1/?mod=x&utm_source=y#f", urls.article_id) == "ecb497c1"
    assert one(spark, "https://a/b-2/x-123e4567-e89b-42d3-A456-426614174000", urls.article_id) == "123e4567-e89b-42d3-a456-426614174000"
    assert one(spark, "https://a/articles/story-1234567", urls.article_id) == one(spark, "https://abcdef12", urls.article_id) == one(spark, "https://a/story_abcdef12", urls.article_id) == ""
    assert one(spark, "https://a/abcdef123456.html", urls.article_id) == "" and one(spark, "https://a/abcdef123456", urls.article_key) == "id:abcdef123456"


def test_text(spark):
    assert one(spark, "<a href='x'>&", text.html_escape) == "&lt;a href=&#x27;x&#x27;&gt;&amp;"
    assert one(spark, "aé", lambda c: text.truncate_bytes(c, 2)) == "a"
    assert one(spark, "x" * 3001, lambda c: F.size(text.chunks(c, 1500))) == 3
    assert one(spark, "see https://x.y/z The cat sat", lambda c: text.tokens_analytics(c)) == ["see", "The", "cat", "sat"]


def test_ratio_is_the_standard_one(spark):
    pairs = [("abcd", "bcde"), ("", "a"), ("same", "same")]
    got = [r[0] for r in spark.createDataFrame(pairs, "a string, b string").select(similarity.ratio("a", "b")).collect()]
    assert got == [SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def test_tombstones_and_return(spark):
    rows = [("2024-01-01", "s", k, f"2024-01-01 {h:02}:00:00", f"{h:02}:00", r) for k, h, r in ((1, 1, 3), (1, 3, 5), (2, 1, 1), (2, 2, 2), (2, 3, 2))]
    obs = spark.createDataFrame(rows, "d string, source_id string, item_key int, t string, crawl_time string, rank int").select(F.to_date("d").alias("crawl_date"), "source_id", "item_key", F.to_timestamp("t").alias("crawl_ts"), "crawl_time", "rank")
    batches = obs.select("source_id", "crawl_date", "crawl_ts").distinct()
    assert [(r.item_key, r.crawl_time) for r in history.tombstones(obs, batches).collect()] == [(1, "02:00")]
    line = sorted((r.crawl_time, r["rank"]) for r in history.timeline(obs, batches).where("item_key = 1").collect())
    assert line == [("01:00", 3), ("02:00", 0), ("03:00", 5)]


def test_leaders_in_order(spark):
    items = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "title string, k int")
    near = spark.createDataFrame([("a", 1, "b"), ("b", 2, "c"), ("c", 3, "d")], "lead string, lead_k int, member string")
    got = dict(tuple(r) for r in rounds.leaders(items, near).collect())
    assert got == {"a": "a", "b": "a", "c": "c", "d": "c"}


def test_packing_keeps_every_line_and_the_cap(spark):
    rows = [("k", i, "x" * n) for i, n in enumerate((3, 5, 40, 2, 9, 9))]
    out = packed(spark.createDataFrame(rows, "key string, pos int, line string"), "key", ["pos"], "line", 20).orderBy("batch").collect()
    assert sum(r.n for r in out) == 6 and all(r.bytes <= 20 or r.n == 1 for r in out)


def _titles():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghiorstn") for _ in range(rng.randrange(2, 8))) for _ in range(60)]
    titles = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 11))) for _ in range(60)]
    for t in titles[:25]:
        x = list(t)
        for _ in range(max(1, len(x) // 8)):
            x[rng.randrange(len(x))] = rng.choice("ABCxyz é")
        titles.append("".join(x))
    return [*titles, titles[0], titles[0].upper(), "", None, "ab", "ac"]


def _tokens(x):
    return {w for w in re.findall(r"\w+", x) if len(w) >= 2}


def _jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def test_searches_against_brute_force(spark):
    rows = list(enumerate(_titles()))
    t = spark.createDataFrame(rows, "doc_id long, title string")
    asked = t.where("doc_id % 20 = 0 and title <> ''").selectExpr("doc_id query_id", "title ref")
    pairs = [(q, d, r, x) for q, r in rows if q % 20 == 0 and r for d, x in rows if x]
    ratio = lambda a, b: SequenceMatcher(None, a, b).ratio()
    got = lambda df: {(r[0], r[1]): round(r[2], 9) for r in df.collect()}
    rounded = lambda x: {k: round(v, 9) for k, v in x.items()}
    assert got(similarity.similar(asked, t, 0.4)) == rounded({(q, d): s for q, d, r, x in pairs if r != x and (s := ratio(r, x)) >= 0.4})
    assert got(similarity.token_similar(asked, t)) == rounded({(q, d): s for q, d, r, x in pairs if (s := _jaccard(_tokens(r), _tokens(x))) > 0})
    for a, b, least in ((0.7, 0.3, 0.35), (0.3, 0.7, 0.25)):
        scores = {(q, d): a * ratio(r.lower(), x.lower()) + b * _jaccard(_tokens(r), _tokens(x)) for q, d, r, x in pairs if r != x}
        assert got(similarity.related(asked, t, a, b, least)) == rounded({k: v for k, v in scores.items() if v >= least})
    expected = {}
    for q, d, r, x in pairs:
        own, s = _tokens(r.lower()), ratio(r.lower(), x.lower())
        overlap = len(own & _tokens(x.lower())) / len(own) if own else 0.0
        score = 1.0 if r.lower() in x.lower() else s if s >= 0.5 else overlap if overlap >= 0.5 else None
        if score is not None:
            expected[q, d] = score
    assert got(similarity.fuzzy(asked, t, 0.5)) == rounded(expected)


def test_clusters_against_a_greedy_loop(spark):
    rng = random.Random(12)
    base = "the minister of the eastern region said on monday that the bridge would be rebuilt soon"
    titles = sorted({x for x in _titles() if x} | {base} | {"".join(rng.choice("xyzqj") if rng.randrange(8) == 0 else c for c in base) for _ in range(30)})
    weights = {x: float(rng.randrange(5)) for x in titles}
    leads, of = [], {}
    for x in sorted(titles, key=lambda x: (-weights[x], x)):
        of[x] = next((y for y in leads if _may(y, x) and SequenceMatcher(None, y, x).ratio() >= 0.7), x)
        leads += [x] if of[x] == x else []
    df = spark.createDataFrame([(x, 1, w, 1, ["s"]) for x, w in weights.items()], "title string, n long, weight double, best_rank int, sources array<string>")
    assert {r.leader: r["size"] for r in similarity.clusters(df, 0.7).collect()} == {y: sum(z == y for z in of.values()) for y in leads}


def _may(a, b):
    return min(len(a), len(b)) >= 0.35 * max(len(a), len(b)) and _jaccard(set(a), set(b)) >= 0.35


def test_block_ratio():
    """The ratio by runs of bits is the standard library's, ties and long titles included; under the bound it is 0."""
    rng = random.Random(5)
    for letters in ("ab", "abcde", "abcdefghij klmnop\U0001f600"):
        for _ in range(300):
            a, b = ("".join(rng.choice(letters) for _ in range(rng.randrange(100))) for _ in "ab")
            rows = similarity.letter_rows(b) if len(b) < 88 else None
            for least in (0.0, 0.4, 0.7):
                r = SequenceMatcher(None, a, b).ratio()
                assert similarity.block_ratio(a, b, rows, least) == (r if r >= least else 0.0)


def test_ratios_of_many_pairs_at_once():
    """All pairs of a block together give the standard library's ratios, over edges of words, long and empty titles, and no single pair is looked at alone."""
    import numpy as np

    rng = random.Random(7)
    lengths = (0, 1, 2, 5, 20, 63, 64, 65, 80, 127, 128, 140)
    for letters in ("ab", "abcde", "abcdefghij klmnop\U0001f600", "a\u00e9\0x"):
        a, b = (["".join(rng.choice(letters) for _ in range(rng.choice(lengths))) for _ in range(24)] for _ in "ab")
        b += a[:4]
        expected = np.array([[SequenceMatcher(None, x, y).ratio() for y in b] for x in a])
        for least in (0.0, 0.4, 0.7):
            got = similarity.ratios(a, b, np.ones(expected.shape, bool), least)
            assert (got == np.where(expected >= least, expected, 0)).all()
        assert (similarity._bounds(a, b) >= np.where(expected == 1, 0, expected) - 1e-9).all()


def test_ratios_of_a_block_ask_for_no_pair_alone(monkeypatch):
    import numpy as np

    monkeypatch.setattr(similarity, "block_ratio", None)
    assert similarity.ratios(["abcd", "xy"], ["bcda", "", "yx"], np.ones((2, 3), bool), 0.4).tolist() == [[0.75, 0, 0], [0, 0, 0.5]]


def test_common_counts(monkeypatch):
    monkeypatch.setattr(similarity, "_COLUMNS", 3)
    a, b = [["x", "y", "z", "u", "v"], [], ["w"]], [["v", "x", "q", "u", "y"], ["z"]]
    assert similarity.common_counts(a, b).tolist() == [[len(set(x) & set(y)) for y in b] for x in a]


def test_link_counts_equal_pairs_one_by_one():
    """Ranges of lengths and products of matrices count what a test of each pair does, ties at the threshold included."""
    import random

    import numpy as np

    from tidemark.operators.similarity import link_counts

    rng = random.Random(4)
    titles = sorted(("".join(rng.choice(of) for _ in range(rng.choice((1, 2, 7, 20, 57, 80)))) for of in ("abc de", "abcdefghijklmnopqrst", "\u4e00\u4e01\u4e02\U0001f600ab") for _ in range(60)), key=len)
    sets = ["".join(sorted(set(x))) for x in titles]
    n = np.array([len(x) for x in titles])

    def near(i, j):
        a, b, both = set(titles[i]), set(titles[j]), len(set(titles[i]) & set(titles[j]))
        return 100 * min(n[i], n[j]) >= 35 * max(n[i], n[j]) and 100 * both >= 35 * (len(a) + len(b) - both)

    rows, cols = range(0, 180, 2), range(1, 180, 2)
    left, right = link_counts(n[::2], sets[::2], n[1::2], sets[1::2], 0.7)
    assert left.tolist() == [sum(near(i, j) for j in cols) for i in rows]
    assert right.tolist() == [sum(near(i, j) for i in rows) for j in cols]
    assert 0 < left.sum() < 90 * 90


def test_pairs_of_a_search_are_not_shuffled(spark):
    t = spark.range(100).selectExpr("id doc_id", "concat('title number ', id % 7) title")
    asked = t.where("doc_id % 20 = 0").selectExpr("doc_id query_id", "title ref")
    for df in (similarity.token_similar(asked, t), similarity.related(asked, t, 0.3, 0.7, 0.25)):
        above = df._jdf.queryExecution().optimizedPlan().toString().split("FlatMapGroupsIn")[0]
        assert "Join" not in above and "Repartition" not in above and len(above.splitlines()) < 5


def test_copies_and_null_ids_in_parts(spark, monkeypatch):
    monkeypatch.setattr(similarity, "_COPIES", 4)
    rows = [(k if k % 9 else None, f"title number {k * k % 11}" if k % 3 else "title number 1") for k in range(90)] + [(None, None), (7, ""), (2**62 + 20, "title number 1")]
    t = spark.createDataFrame(rows, "doc_id long, title string")
    asked = [(k, x) for k, x in rows if k is not None and k % 20 == 0 and x]
    asked += [(k + 1000, "title number 1") for k in range(30)]
    got = sorted((r[0], r[1] is None, r[1] or 0, r[2]) for r in similarity.token_similar(spark.createDataFrame(asked, "query_id long, ref string"), t).collect())
    assert got == sorted((q, d is None, d or 0, _jaccard(_tokens(r), _tokens(x))) for q, r in asked for d, x in rows if x and _tokens(r) & _tokens(x))
    texts = similarity._texts(t, "title", "doc_id").where("title = 'title number 1'").collect()
    assert len(texts) > 4 and sum(len(r["ids"]) + r["nulls"] for r in texts) == sum(x == "title number 1" for _, x in rows)
    empty = spark.createDataFrame([], "doc_id long, title string")
    assert similarity.token_similar(spark.createDataFrame(asked, "query_id long, ref string"), empty).collect() == []


def test_blocks_of_several_tiles_meet_once_and_send_few_copies(spark, monkeypatch):
    monkeypatch.setattr(blocks, "TILE", (50, 70))
    left, right = spark.range(900).withColumnRenamed("id", "a"), spark.range(700).withColumnRenamed("id", "b")
    pairs = lambda x, y: pd.DataFrame({"a": np.repeat(x["a"].to_numpy(np.int64), len(y)), "b": np.tile(y["b"].to_numpy(np.int64), len(x))})
    met = lambda: blocks.per_block(left, right, ["a"], ["b"], pairs, "a long, b long")
    monkeypatch.setattr(blocks, "MOST", (200, 300))
    assert (met().count(), met().distinct().count()) == (630_000, 630_000)
    monkeypatch.setattr(blocks, "MOST", (16384, 16384))
    monkeypatch.setattr(blocks, "_BLOCKS", 1)  # small tables are cut further, for the sake of tasks
    sizes = lambda x, y: pd.DataFrame({"a": [len(x)], "b": [len(y)]})
    monkeypatch.setattr(blocks, "TILE", (16384, 16384))
    assert blocks.per_block(left, right, ["a"], ["b"], sizes, "a long, b long").agg({"b": "sum"}).first()[0] == 700  # once for each stripe of the left side, which is one


def test_first_longest_run_and_what_lies_around_it():
    rng = random.Random(31)
    a = ["".join(rng.choice("abcde ") for _ in range(rng.choice([1, 7, 63, 64, 65, 100, 127]))) for _ in range(12)]
    b = a[:2] + ["".join(rng.choice("abcdef") for _ in range(rng.choice([1, 2, 64, 80, 127]))) for _ in range(12)] + [x[40:] + x[:40] for x in a[:4]]
    ids, words = similarity.letter_places(a, b)
    i, j = (x.ravel() for x in np.indices((len(a), len(b))))
    table = words[:, ids[:, i], j]
    first = similarity._first_longest(table)
    whole, places = similarity._in_order(table), np.stack([words[0] & similarity._LOW, words[1] << np.uint64(1) | words[0] >> np.uint64(63)], axis=1)
    for at, (x, y) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        m = SequenceMatcher(None, a[x], b[y], autojunk=False).find_longest_match()
        assert tuple(c[at] for c in first) == ((m.a, m.b, m.size) if m.size > 1 else (0, 0, 0))
        assert whole[at] == similarity._in_order_all(ids[: len(a[x]), x], places)[y]
    around, (p, q, k) = similarity._around(table, first), first
    bits = lambda t, r, c: t[c >> 6, r, :] >> np.uint64(c & 63) & np.uint64(1)
    for r in range(table.shape[1]):
        for c in range(127):
            left = ((r < p) & (c < q)) | ((r >= p + k) & (c >= q + k))
            assert (bits(around, r, c) == np.where(left, bits(table, r, c), 0)).all()


def test_most_unlike_pairs_go_by_their_longest_run(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    a, b = (["".join(rng.choice(words) + " " for _ in range(16))[:80] for _ in range(n)] for n in (20, 150))
    looked, run = [], similarity._matched
    monkeypatch.setattr(similarity, "_matched", lambda table, need: looked.append(len(need)) or run(table, need))
    got = similarity.ratios(a, b, np.ones((20, 150), bool), 0.4)
    expected = np.array([[r if (r := SequenceMatcher(None, x, y).ratio()) >= 0.4 else 0.0 for y in b] for x in a])
    in_order = (2 * similarity.common_lengths([x for x in a for _ in b], b * len(a)) >= 0.4 * np.array([len(x) + len(y) for x in a for y in b]) - 1e-9).sum()
    assert (got == expected).all() and sum(looked) < 0.8 * in_order


def test_most_similar_has_bars_and_keeps_ties(spark, monkeypatch):
    monkeypatch.setattr(similarity, "_FIRST", 2)
    rng = random.Random(17)
    rows = [(k, "".join(rng.choice("abc") for _ in range(rng.choice([5, 6])))) for k in range(120)] + [(k, "abcab") for k in range(120, 126)]
    t = spark.createDataFrame(rows, "doc_id long, title string")
    asked = t.where("doc_id % 20 = 0").selectExpr("doc_id query_id", "title ref")
    bars, run = [], similarity.similar
    monkeypatch.setattr(similarity, "similar", lambda q, *more: bars.append("least" in q.columns and [r[0] for r in q.select("least").collect()]) or run(q, *more))
    got = sorted(map(tuple, similarity.most_similar(asked, t, 0.4, 10).select("query_id", "place", "doc_id", "similarity").collect()))
    expected = []
    for q, r in rows[::20]:
        near = sorted((-s, d) for d, x in rows if x != r and (s := SequenceMatcher(None, r, x).ratio()) >= 0.4)
        expected += [(q, place, d, -s) for place, (s, d) in enumerate(near[:10], 1)]
    assert got == sorted(expected) and max(bars[-1]) > 0.4


def test_clusters_compare_once(spark, monkeypatch):
    plans, run = [], similarity.leaders
    monkeypatch.setattr(similarity, "leaders", lambda items, near: plans.append(near._jdf.queryExecution().optimizedPlan().toString()) or run(items, near))
    df = spark.createDataFrame([("abcdef", 1, 2.0, 1, ["s"]), ("abcdeg", 1, 1.0, 1, ["s"])], "title string, n long, weight double, best_rank int, sources array<string>")
    assert [r["size"] for r in similarity.clusters(df, 0.7).collect()] == [2] and "FlatMapGroups" not in plans[0]
