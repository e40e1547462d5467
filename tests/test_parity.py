"""Every query that has SQL gives the rows that DuckDB gives for it."""

import math

import pytest

from tests.conftest import SF
from tidemark.plans.registry import oracle_sql, queries


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_and_sql_agree(name, spark, duck):
    df = queries()[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted(tuple(value(r[c]) for c in columns) for r in df.collect())
    rel = duck.sql(oracle_sql()[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert ours == sorted(tuple(value(r[i]) for i in at) for r in rel.fetchall())


def test_sql_is_of_known_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["word", "place", "title", "source_id", "weight", "count", "percentage"]
