"""Queries of tags over versions. Interests are sources; a version wants the words that are the most frequent in the titles that it sees."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import tags as T
from tidemark.plans.catalog import query
from tidemark.sources import tables as S
from tidemark.sources.tables import with_

#: Which titles each version looks at for its tags; items come in with the versions too.
SEEN = ("doc_id % 4 = 0", "doc_id % 4 <= 1", "doc_id % 40 = 7", "doc_id % 4 <= 2")
_WORDS, _TAGS = "[a-z]{4,}", 5


def _final(spark: SparkSession, sf_dir: str) -> T.Snapshot:
    titles = S.titles_doc(spark, sf_dir).where("title <> ''").select(F.col("source_id").alias("interest"), F.col("doc_id").alias("item_id"), F.lower("title").alias("title"))

    def step(s: T.Snapshot, version: int) -> T.Snapshot:
        seen = titles.where(SEEN[version].replace("doc_id", "item_id"))
        words = seen.select("interest", F.explode(F.array_distinct(F.regexp_extract_all("title", F.lit(_WORDS), 0))).alias("tag")).groupBy("interest", "tag").agg(F.count("*").alias("n"))
        p = F.row_number().over(Window.partitionBy("interest").orderBy(F.desc("n"), "tag"))
        s = T.updated(s, words.withColumn("p", p).where(F.col("p") <= _TAGS).select("interest", "tag", "p"), version)
        items = T.pending(s, titles.where(f"item_id % 4 <= {version}"))
        active = s.tags.where("status = 'active'").groupBy("interest").agg(F.collect_list("tag").alias("tags"))  # a few
        found = items.join(active, "interest").select("interest", "item_id", "title", F.explode("tags").alias("tag")).where(F.contains("title", F.col("tag")))
        return T.classified(s, found, items, version)

    return reduce(step, range(len(SEEN)), T.empty(spark))


def _sql() -> str:
    """All versions, one after another."""
    out = [", x AS (SELECT source_id AS interest, doc_id, lower(title) AS title FROM titles_doc WHERE title <> '')"]
    for v, seen in enumerate(SEEN):
        old = f"(SELECT * FROM t{v - 1})" if v else "(SELECT ''::VARCHAR AS interest, ''::VARCHAR AS tag, 0 AS version, ''::VARCHAR AS status, 0 AS priority WHERE FALSE)"
        results = f"(SELECT * FROM r{v - 1})" if v else "(SELECT ''::VARCHAR AS interest, 0::BIGINT AS doc_id, ''::VARCHAR AS tag, 0 AS version, ''::VARCHAR AS status WHERE FALSE)"
        ledger = f"(SELECT * FROM l{v - 1})" if v else "(SELECT ''::VARCHAR AS interest, 0::BIGINT AS doc_id, TRUE AS matched, 0 AS version WHERE FALSE)"
        out.append(f"""w{v} AS (SELECT * FROM (SELECT interest, tag, row_number() OVER (PARTITION BY interest ORDER BY count(*) DESC, tag) AS p FROM (SELECT DISTINCT interest, doc_id, unnest(regexp_extract_all(title, '{_WORDS}')) AS tag FROM x WHERE {seen}) GROUP BY interest, tag) WHERE p <= {_TAGS}),
b{v} AS (SELECT coalesce(a.interest, w.interest) AS interest, coalesce(a.tag, w.tag) AS tag, a.tag IS NOT NULL AS old, w.p FROM (SELECT * FROM {old} o WHERE status = 'active' AND interest IN (SELECT interest FROM w{v})) a FULL JOIN w{v} w ON a.interest = w.interest AND a.tag = w.tag),
k{v} AS (SELECT interest, count(*) FILTER (old AND p IS NOT NULL) AS kept, CASE WHEN count(*) FILTER (old) = 0 THEN 'first' WHEN 1 - count(*) FILTER (old AND p IS NOT NULL) / count(*) >= {T.THRESHOLD} THEN 'full' ELSE 'incremental' END AS kind FROM b{v} GROUP BY 1),
c{v} AS (SELECT b.*, kept, kind FROM b{v} b JOIN k{v} USING (interest)),
stay{v} AS (SELECT interest, tag, row_number() OVER (PARTITION BY interest ORDER BY p) AS n FROM c{v} WHERE kind = 'incremental' AND old AND p IS NOT NULL),
gone{v} AS (SELECT interest, tag FROM c{v} WHERE old AND (kind = 'full' OR p IS NULL)),
new{v} AS (SELECT interest, tag, {v} AS version, 'active' AS status, (row_number() OVER (PARTITION BY interest ORDER BY p) + CASE WHEN kind = 'incremental' THEN kept ELSE 0 END)::INT AS priority, kind FROM c{v} WHERE p IS NOT NULL AND (kind <> 'incremental' OR NOT old)),
t{v} AS (SELECT o.interest, o.tag, version, CASE WHEN status = 'active' AND g.tag IS NOT NULL THEN 'deprecated' ELSE status END AS status, CASE WHEN status = 'active' AND s.n IS NOT NULL THEN s.n::INT ELSE priority END AS priority
FROM {old} o LEFT JOIN gone{v} g ON g.interest = o.interest AND g.tag = o.tag LEFT JOIN stay{v} s ON s.interest = o.interest AND s.tag = o.tag UNION ALL SELECT interest, tag, version, status, priority FROM new{v}),
m{v} AS (SELECT * FROM {ledger} l WHERE interest NOT IN (SELECT interest FROM k{v} WHERE kind = 'full') AND (matched OR interest NOT IN (SELECT interest FROM new{v} WHERE kind = 'incremental'))),
p{v} AS (SELECT * FROM x WHERE doc_id % 4 <= {v} AND (interest, doc_id) NOT IN (SELECT (interest, doc_id) FROM m{v})),
f{v} AS (SELECT p.interest, p.doc_id, a.tag, a.version FROM p{v} p JOIN t{v} a ON a.interest = p.interest AND a.status = 'active' AND contains(p.title, a.tag)),
o{v} AS (SELECT r.interest, r.doc_id, r.tag, r.version, CASE WHEN g.tag IS NULL THEN r.status ELSE 'deprecated' END AS status FROM {results} r LEFT JOIN gone{v} g ON g.interest = r.interest AND g.tag = r.tag),
r{v} AS (SELECT * FROM o{v} UNION ALL SELECT interest, doc_id, tag, version, 'active' FROM f{v} WHERE (interest, doc_id, tag, version) NOT IN (SELECT (interest, doc_id, tag, version) FROM o{v})),
l{v} AS (SELECT * FROM m{v} UNION ALL SELECT interest, doc_id, (interest, doc_id) IN (SELECT (interest, doc_id) FROM f{v}), {v} FROM p{v})""")  # fmt: skip
    return ",\n".join(out)


_LAST = len(SEEN) - 1


@query(with_("titles_doc", body=f"{_sql()} SELECT * FROM t{_LAST}"))
def tag_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AI-1, ST-10, ST-11: all tags after some versions, with their version, status and priority."""
    return _final(spark, sf_dir).tags


@query(with_("titles_doc", body=f"{_sql()} SELECT interest, doc_id AS item_id, tag, version, status FROM r{_LAST}"))
def tag_version_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-10, ST-13: all results; those of deprecated tags went with them."""
    return _final(spark, sf_dir).results


@query(with_("titles_doc", body=f"{_sql()} SELECT interest, doc_id AS item_id, matched, version FROM l{_LAST}"))
def tag_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-12, JN-9: items that were analysed, in which version the last time, and whether they matched a tag."""
    return _final(spark, sf_dir).ledger
