"""The pipeline: each stage's rows against brute force over what the stage before kept."""

import base64

import public_tokenizers
import pytest

from tests.conftest import SF
from tests.llm import brute
from tidemark.llm import quality
from tidemark.llm.registry import RANK_FILE

corpus_pipeline = pytest.importorskip("corpus_pipeline", reason="it goes with the subpackage")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets, and the last one's result: rows as (doc_id, text, lang)."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, out = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path_factory.mktemp('stage')}/{name}"
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    assert all(x.columns == columns for x in out[:-1])
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang").collect()]


def test_quality_stage(spark, stages):
    said = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()]
    judged = brute.quality(rows(stages[0]), said, quality.GRID, quality.RISK, quality.DOUBT)
    assert sorted(d for d, *_ in rows(stages[1])) == sorted(x[0] for x in judged if x[-1])


def test_lines_stage(stages):
    before, after = dict(x[:2] for x in rows(stages[1])), dict(x[:2] for x in rows(stages[2]))
    assert before.keys() == after.keys()
    lines = [x.strip() for t in after.values() for x in t.split("\n") if x.strip()]
    assert len(lines) == len(set(lines))
    for d, t in after.items():
        left = iter(before[d].split("\n"))
        assert not t or all(x in left for x in t.split("\n"))
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_near_duplicates_stage(stages):
    found = brute.near_duplicates([x[:2] for x in rows(stages[2])])
    assert sorted(x[0] for x in rows(stages[3])) == sorted(d for d, _, root in found if d == root)


def test_benchmark_stage(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hits = brute.benchmark([x[:2] for x in rows(stages[3])], items)
    assert sorted(x[0] for x in rows(stages[4])) == sorted(x[0] for x in hits if not x[-1])


def test_tokens_stage(stages):
    import tiktoken

    with open(RANK_FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = [(d, len(ids := plain.encode_ordinary(t)), brute.hexed(" ".join(map(str, ids))), brute.hexed(t)) for d, t, _ in rows(stages[4])]
    assert sorted(tuple(r) for r in stages[5].select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == sorted(expected)


def test_run(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, stages[5].collect()))


def test_stages_on_edge_rows(spark, edge, none):
    for start in (edge, none):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= start.count()
            docs = out if out.columns == docs.columns else docs
