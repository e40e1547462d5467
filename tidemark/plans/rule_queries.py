"""Queries of large rule sets: every third title makes a group of its first three words, some make words that reject."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import rule_match as R
from tidemark.plans.catalog import query
from tidemark.sources import tables as S
from tidemark.sources.tables import with_

_WORDS = "[a-z]{3,}"


def rules_of(titles: DataFrame) -> DataFrame:
    """position, role, word."""
    t = titles.select("doc_id", F.regexp_extract_all(F.lower("title"), F.lit(_WORDS), 0).alias("w"))
    at = lambda *k: F.transform(F.array(*map(F.lit, k)), lambda i: F.get("w", i))
    role = lambda where, name, *k: t.where(where).select(F.col("doc_id").cast("int").alias("position"), F.lit(name).alias("role"), F.explode(at(*k)).alias("word"))
    group = "doc_id % 3 = 0 and size(w) >= 3"
    return role(group, "required", 0).unionByName(role(group, "normal", 1, 2)).unionByName(role("doc_id % 97 = 5 and size(w) >= 6", "excluded", 5))


@query(with_("titles_doc", body=f""", w AS (SELECT doc_id, regexp_extract_all(lower(title), '{_WORDS}') AS w FROM titles_doc), g AS (SELECT doc_id AS position, w[1] AS r, w[2] AS a, w[3] AS b FROM w WHERE doc_id % 3 = 0 AND len(w) >= 3),
no AS (SELECT DISTINCT d.doc_id FROM titles_doc d JOIN w ON w.doc_id % 97 = 5 AND len(w.w) >= 6 AND contains(lower(d.title), w.w[6])),
hit AS (SELECT d.doc_id, min(position) AS position FROM titles_doc d JOIN g ON contains(lower(d.title), r) AND (contains(lower(d.title), a) OR contains(lower(d.title), b)) WHERE trim(d.title) <> '' AND d.doc_id NOT IN (SELECT doc_id FROM no) GROUP BY 1)
SELECT d.doc_id, coalesce(position, -1)::INT AS position FROM titles_doc d LEFT JOIN hit USING (doc_id)"""))
def large_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX-3, JN-14, SRC-15: the group of each title by rules that come as a table."""
    t = S.titles_doc(spark, sf_dir)
    return R.positions(t.select("doc_id", "title"), rules_of(t), "title").select("doc_id", F.coalesce("position", F.lit(-1)).alias("position"))
