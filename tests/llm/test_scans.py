"""op3, op4, op6, op7 against brute force."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm import brute
from tidemark.llm import decontaminate, pii, quality, secrets
from tidemark.llm.registry import oracle_sql, op3_secrets, op4_decontaminate, op6_quality, op7_personal_data

HITS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
JUDGED = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def _joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in spans)


def _secrets(rows):
    out = []
    for d, text in rows:
        found = brute.secrets(text)
        out.append((d, *[sum(x[0] == k for x in found) for k in brute.SECRETS], brute.hexed(_joined(found))))
    return out


def test_secrets(spark, edge, pairs, small, same):
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    same(secrets.secrets(edge), columns, _secrets(pairs))
    same(op3_secrets(spark, SF), columns, _secrets(small[1]))


def test_secrets_sql(spark, duck):
    got = sorted(tuple(map(str, r)) for r in op3_secrets(spark, SF).collect())
    assert got == sorted(tuple(map(str, r)) for r in duck.sql(oracle_sql()["op3_secrets"]).fetchall())


def test_copied_secret_is_not_live(spark):
    value = "q7Wz9LmN2pRt5"
    rows = [(1, f"token = {value}", "a", "en"), (2, f"token: {value}", "b", "en"), (3, "x token=Zr8kQ2mP0vLs7 y", "a", "en"), (4, None, None, None), (5, "api_key='EXAMPLEkey99zzQ'", "a", "en")]
    got = {r.doc_id: r.spans for r in secrets.secrets(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()}
    assert got[1] == "assign:0:21" and "live" not in got[2] and "live" not in got[5]
    assert got[3] == "assign:2:21,live:8:21" and got[4] == ""


def test_benchmark(spark, edge, pairs, small, same):
    w = pairs[5][1].split()
    items = [(1, " ".join(w[3:30])), (2, "w1 w2"), (3, ""), (4, None), (None, " ".join(w[40:52])), (2, "same same same same same same same same same same same"), (5, "SAME")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute.benchmark(pairs, items)
    same(decontaminate.contamination(edge, bench), HITS, expected)
    same(decontaminate.contamination(edge, bench, part_chars=100), HITS, expected)  # many passes
    clean = decontaminate.drop_contaminated(edge, bench)
    assert clean.columns == edge.columns and sorted(map(str, (r.doc_id for r in clean.collect()))) == sorted(str(x[0]) for x in expected if not x[5])
    assert decontaminate.contamination(edge, bench.limit(0)).where("contaminated").count() == 0
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    same(op4_decontaminate(spark, SF), HITS, brute.benchmark(small[1], items))


def test_quality(spark, edge, edge_rows, small, same):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = [tuple(r) for r in small[0].select("doc_id", "text", "lang").collect()]
    said = [tuple(r) for r in labels.select("doc_id", "quality").collect()]
    same(op6_quality(spark, SF), JUDGED, brute.quality(docs, said, quality.GRID, quality.RISK, quality.DOUBT))
    # so loose that cutoffs are found
    same(quality.quality(small[0], labels, risk=0.3, doubt=0.9), JUDGED, brute.quality(docs, said, quality.GRID, 0.3, 0.9))
    rows = [(d, t, lang) for d, t, lang, _ in edge_rows]
    mine = [(4, 1), (5, 1), (5, 0), (None, 1), (7, None)]
    table = spark.createDataFrame(mine, "doc_id long, quality int")
    expected = brute.quality(rows, mine, quality.GRID, quality.RISK, quality.DOUBT)
    same(quality.quality(edge, table), JUDGED, expected)
    kept = quality.keep_good(edge, table)
    assert kept.columns == edge.columns and kept.count() == sum(x[-1] for x in expected)
    assert all(r["_m"] == "_m" and r["_stratum"] == "_stratum" for r in kept.collect())
    assert quality.quality(edge, table.limit(0)).count() == len(rows)


def test_binomial_bound(spark):
    cases = [(1000, 0), (1000, 1), (1000, 3), (5000, 9), (60, 0), (10, 10)]
    got = [r[0] for r in spark.createDataFrame(cases, "n long, k long").select(quality._at_most(F.col("n"), F.col("k"), 0.005)).collect()]
    assert got == pytest.approx([brute.at_most(n, k, 0.005) if k < n * 0.005 else 1.0 for n, k in cases])


def _personal(rows):
    out = []
    for d, text in rows:
        found = brute.personal(text)
        out.append((d, *[sum(x[0] == k for x in found) for k in pii.BASE_KINDS], brute.hexed(_joined(found))))
    return out


def test_personal_data(spark, edge, pairs, small, same):
    columns = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    same(pii.personal_data(edge), columns, _personal(pairs))
    same(op7_personal_data(spark, SF), columns, _personal(small[1]))


@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(alphabet="a.@+-0192 (x:/é😀%", max_size=60))
def test_personal_data_of_any_text(text):
    got = [x for x in pii.Finder().spans(text) if x[0] in pii.BASE_KINDS]
    assert got == brute.personal(text)


def test_added_kinds():
    spans = lambda text: [(k, text[a:b]) for k, a, b in pii.Finder().spans(text)]
    assert ("iban", "DE89 3704 0044 0532 0130 00") in spans("IBAN: DE89 3704 0044 0532 0130 00.")
    assert ("iban", "DE88 3704 0044 0532 0130 00") not in spans("IBAN: DE88 3704 0044 0532 0130 00.")
    assert ("login", "https://me:pw@host.org") in spans("see https://me:pw@host.org/x")
    assert ("account", "12345678") in spans("account no. 12345678,")


def test_empty(none, spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert secrets.secrets(none).count() == decontaminate.contamination(none, bench).count() == quality.quality(none, labels).count() == pii.personal_data(none).count() == 0


def test_items_with_names(spark):
    """Ids that are no numbers are sorted as strings, as numbers are."""
    import hashlib

    passage = lambda k: " ".join(f"p{k}x{i}" for i in range(12))
    docs = spark.createDataFrame([(1, passage(1) + " and " + passage(2)), (2, "nothing of it"), (3, None)], "doc_id long, text string")
    for names in (["b-2", "a-10"], [9, 10]):
        bench = spark.createDataFrame([(names[0], passage(1)), (names[1], passage(2)), (None, passage(3))], f"item_id {'string' if isinstance(names[0], str) else 'long'}, text string")
        got = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
        assert got[1].n_items == 2 and got[1].n_hit == 24 and got[1].items_sha256 == hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest()
        assert not got[2].contaminated and got[3].n_words == 0
        assert decontaminate.drop_contaminated(docs, bench).count() == 2
