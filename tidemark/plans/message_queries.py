"""Queries of messages of a bounded size. The SQL walks one unit after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import urls as U
from tidemark.operators import delivery as D
from tidemark.operators import report as R
from tidemark.operators import stretches
from tidemark.operators.rounds import checkpointed
from tidemark.operators.splitting import split_column
from tidemark.plans import rules as K
from tidemark.plans.catalog import query
from tidemark.sources import tables as S
from tidemark.sources.tables import with_


def _walk(most: int) -> str:
    """Of u (key, at, size, text, fresh): the message of each unit, and its size so far."""
    return f"""r AS (SELECT key, no, strlen(fresh)::BIGINT AS bytes, 1::BIGINT AS message, fresh AS said FROM u WHERE no = 0 UNION ALL
SELECT u.key, u.no, CASE WHEN r.bytes + strlen(u.text) <= {most} THEN r.bytes + strlen(u.text) ELSE strlen(u.fresh) END, r.message + CASE WHEN r.bytes + strlen(u.text) <= {most} THEN 0 ELSE 1 END,
CASE WHEN r.bytes + strlen(u.text) <= {most} THEN u.text ELSE u.fresh END FROM r JOIN u ON u.key = r.key AND u.no = r.no + 1)"""


def _recursive(names: tuple[str, ...], body: str) -> str:
    return with_(*names, body=body).replace("WITH ", "WITH RECURSIVE ", 1)


def _packed_sql(name: str, rows: str, most: int, header: str, columns: str) -> str:
    """rows: key, line and the order o of all units."""
    return _recursive((name,), f""", u AS (SELECT key, row_number() OVER (PARTITION BY key ORDER BY o) - 1 AS no, line || chr(10) AS text, '{header}' || line || chr(10) AS fresh FROM ({rows})),
{_walk(most)} SELECT {columns} FROM r GROUP BY key, message""")  # fmt: skip


_PACKED = "key, message::INT AS batch, count(*)::INT AS n, max(bytes)::INT AS bytes"


@query(_packed_sql("titles", "SELECT source_id || '/' || date AS key, title AS line, pos AS o FROM titles", 4000, "**list**' || chr(10) || '", _PACKED))
def message_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP-8: titles of each source and day in batches of 4,000 bytes."""
    t = S.titles(spark, sf_dir).select(F.concat_ws("/", "source_id", F.col("date").cast("string")).alias("key"), "title", "pos")
    return D.packed(t, "key", ["pos"], "title", 4000, "**list**\n")


_GROUP_ROWS = "SELECT publisher || '/' || (discovered_at // 2592000) AS key, '- article ' || article_key || ' doc ' || document_id AS line, article_key AS o FROM articles WHERE status = 'shared'"


def _shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.lit("- article "), F.col("article_key").cast("string"), F.lit(" doc "), "document_id")
    return S.articles(spark, sf_dir).where("status = 'shared'").select(F.concat_ws("/", "publisher", F.floor(F.col("discovered_at") / 2592000).cast("string")).alias("key"), line.alias("line"), "article_key", "publisher")


@query(_packed_sql("articles", _GROUP_ROWS, 3800, "", _PACKED))
def message_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OX-8: shared articles of a publisher and month in messages of 3,800 bytes."""
    return D.packed(_shared(spark, sf_dir), "key", ["article_key"], "line", 3800)


_UUID = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-' || substr('89ab', (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)"


@query(_recursive(("articles",), f""", u AS (SELECT key, publisher, article_key, row_number() OVER (PARTITION BY key ORDER BY article_key) - 1 AS no, line || chr(10) AS text, line || chr(10) AS fresh FROM (SELECT publisher || '/' || (discovered_at // 2592000) AS key, publisher, '- article ' || article_key || ' doc ' || document_id AS line, article_key FROM articles WHERE status = 'shared')),
{_walk(3800)}, m AS (SELECT u.key, message, publisher, sha256('tidemark-' || publisher || '-message:' || string_agg(article_key::VARCHAR, ',' ORDER BY article_key::VARCHAR)) AS h FROM r JOIN u USING (key, no) GROUP BY 1, 2, 3)
SELECT article_key, {_UUID} AS message_id FROM r JOIN u USING (key, no) JOIN m USING (key, message)"""))
def message_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OX-8, UR-6: the message of each shared article, named by the articles that it has, so that a repeated run sends none twice."""
    rows = _shared(spark, sf_dir)
    size = F.octet_length("line").cast("long") + 1
    units = stretches.numbered(rows.select("key", "article_key", "publisher", size.alias("size"), size.alias("left"), F.lit(0).cast("long").alias("extra")), ["key"], ["article_key"])
    out = D.dealt(units, 3800).select("key", "message", "publisher", "article_key")
    keys = F.array_join(F.array_sort(F.collect_list(F.col("article_key").cast("string"))), ",")  # at most a message
    named = out.groupBy("key", "message", "publisher").agg(keys.alias("keys")).select("key", "message", U.uuid_of(F.concat(F.lit("tidemark-"), "publisher", F.lit("-message:"), "keys")).alias("message_id"))
    return out.join(named, ["key", "message"]).select("article_key", "message_id")


#: Titles of the regions of a day's report.
_REGIONS = ("热点词汇统计", "本次新增热点新闻", "独立展示区")
_BASE = "**总新闻：** {total} 条\n**类型：** 热点分析报告\n**时间：** {key}\n\n"


def _report_sql(style: D.Style) -> str:
    foot = (style.foot % S.AS_OF).replace("'", "''").replace("\n", "' || chr(10) || '")
    most = style.cap - D.reserve(style) - len((style.foot % S.AS_OF).encode()) - 1
    text = lambda x: "'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    number = text(style.number).replace("%d/%d", "' || message || '/' || total || '")
    base = text(_BASE).replace("{total}", "' || total || '").replace("{key}", "' || key || '")
    b = style.bold
    return _recursive(("titles",), f""", items AS (
SELECT CAST(date AS VARCHAR) AS key, 0 AS region, '{_REGIONS[0]}' AS region_title, lpad(position::VARCHAR, 4, '0') AS group_no, word AS group_name, '[' || source_id || '] ' || title AS line, pos, title FROM (SELECT *, {K.sql(K.RULES)} AS position FROM titles) JOIN (VALUES {", ".join(f"({i}, '{g.name}')" for i, g in enumerate(K.RULES.groups))}) g(position, word) USING (position)
UNION ALL SELECT CAST(date AS VARCHAR), 1, '{_REGIONS[1]}', source_id, source_id, title, pos, title FROM titles WHERE (source_id, title, date) IN (SELECT (source_id, title, min(date)) FROM titles GROUP BY source_id, title)
UNION ALL SELECT CAST(date AS VARCHAR), 2, '{_REGIONS[2]}', source_id, source_id, title, pos, title FROM titles WHERE list_min(ranks) <= 3),
placed AS (SELECT *, row_number() OVER (PARTITION BY key, region, group_no ORDER BY pos, title) - 1 AS place, count(*) OVER (PARTITION BY key, region, group_no) AS count, count(*) OVER (PARTITION BY key, region) AS n, count(*) OVER (PARTITION BY key) AS total, min(group_no) OVER (PARTITION BY key, region) AS first_group, min(region) OVER (PARTITION BY key) AS first_region FROM items),
said AS (SELECT *, {base} AS base, '📊 {b}' || region_title || '{b} (共 ' || n || ' 条)' || chr(10) || chr(10) AS head,
CASE WHEN count >= 10 THEN '🔥 ' WHEN count >= 5 THEN '📈 ' ELSE '📌 ' END || '{b}' || group_name || '{b} : ' || CASE WHEN count >= 5 THEN '{b}' ELSE '' END || count || CASE WHEN count >= 5 THEN '{b}' ELSE '' END || ' 条' || chr(10) || chr(10) AS grp,
'  ' || (place + 1) || '. ' || line || chr(10) || CASE WHEN place + 1 < count THEN chr(10) ELSE '' END AS own FROM placed),
units AS (SELECT DISTINCT key, region, '' AS group_no, -1 AS place, CASE WHEN region > first_region THEN {text(style.rule)} ELSE '' END || head AS text, base || head AS fresh FROM said
UNION ALL SELECT key, region, group_no, place, CASE WHEN place > 0 THEN '' ELSE CASE WHEN group_no > first_group THEN {text(style.gap)} ELSE '' END || grp END || own, base || head || grp || own FROM said),
u AS (SELECT key, row_number() OVER (PARTITION BY key ORDER BY region, group_no, place) - 1 AS no, text, fresh FROM units),
{_walk(most)}, m AS (SELECT key, message, string_agg(said, '' ORDER BY no) || '{foot}' AS text FROM r GROUP BY 1, 2), t AS (SELECT *, count(*) OVER (PARTITION BY key) AS total FROM m),
b AS (SELECT key, message AS batch, {"total + 1 - message" if style.reverse else "message"} AS sent, CASE WHEN total > 1 THEN {number} ELSE '' END || text AS body FROM t)
SELECT key, batch, sent, strlen(body)::INT AS bytes, sha256(body) AS sha256 FROM b""")


def _report_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the reports of all days: by rule group, new ones by source, and those that led a list. Titles are made once for the four that read them."""
    t = checkpointed(S.titles(spark, sf_dir))
    day = F.col("date").cast("string").alias("key")
    line = F.concat(F.lit("["), "source_id", F.lit("] "), "title")
    hot = R.matched(t, K.RULES).join(F.broadcast(R.groups_table(t, K.RULES)), "position")
    hot = hot.select(day, F.lit(0).alias("region"), F.lit(_REGIONS[0]).alias("region_title"), F.lpad(F.col("position").cast("string"), 4, "0").alias("group_no"), F.col("word").alias("group_name"), line.alias("line"), "pos", "title")
    by_source = lambda df, k: df.select(day, F.lit(k).alias("region"), F.lit(_REGIONS[k]).alias("region_title"), F.col("source_id").alias("group_no"), F.col("source_id").alias("group_name"), F.col("title").alias("line"), "pos", "title")
    new = t.join(t.groupBy("source_id", "title").agg(F.min("date").alias("date")), ["source_id", "title", "date"])
    rows = hot.unionByName(by_source(new, 1)).unionByName(by_source(t.where(F.array_min("ranks") <= 3), 2))
    return stretches.numbered(rows, ["key", "region", "group_no"], ["pos", "title"], name="place").drop("pos", "title")


def _report(spark: SparkSession, sf_dir: str, channel: str) -> DataFrame:
    before, _, rest = _BASE.partition("{total}")
    middle, _, end = rest.partition("{key}")
    base = F.concat(F.lit(before), F.col("total").cast("string"), F.lit(middle), "key", F.lit(end))
    out = D.reports(_report_items(spark, sf_dir), D.STYLES[channel], base, S.AS_OF)
    return out.select("key", "batch", "sent", F.octet_length("body").alias("bytes"), F.sha2("body", 256).alias("sha256"))


@query(_report_sql(D.STYLES["wework"]))
def report_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP-8, RP-9: each day's report in messages of 4,000 bytes: regions in order, a group's head with its first title, a foot and a number on each."""
    return _report(spark, sf_dir, "wework")


@query(_report_sql(D.STYLES["ntfy"]))
def report_messages_reversed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP-8, RP-9: the same in messages of 3,800 bytes for a channel that shows the last one first."""
    return _report(spark, sf_dir, "ntfy")


@query()
def numbered_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP-9, RP-10: whole texts in messages of a channel's size, with their numbers, in the order of sending."""
    docs = S.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), F.col("text"))
    out = []
    for channel in ("ntfy", "telegram"):
        style = D.STYLES[channel]
        parts = docs.withColumn("parts", split_column(style.cap - D.reserve(style))("text")).withColumn("total", F.size("parts"))
        rows = parts.select("key", "total", F.posexplode("parts").alias("k", "text")).withColumn("message", F.col("k") + 1)
        out.append(D.sendable(rows, style).select(F.lit(channel).alias("channel"), F.col("key").alias("doc_id"), "batch", "sent", F.octet_length("body").alias("bytes"), F.sha2("body", 256).alias("sha256")))
    return out[0].unionByName(out[1])


@query(with_("titles_doc", body=""" SELECT doc_id, CASE WHEN trim(title) = '' OR doc_id % 7 = 0 THEN title ELSE rtrim('T:' || replace(title, 'e', 'E')) END AS title FROM titles_doc"""))
def translated_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AI-5, TX-19: titles go out in numbered batches and come back to their places; blank ones aren't asked for, and where an answer is blank the title stays."""
    t = S.titles_doc(spark, sf_dir).select("doc_id", "title")
    asked = stretches.numbered(t.where(F.trim("title") != "").withColumn("key", F.lit("titles")), ["key"], ["doc_id"]).select("doc_id", "title", F.floor(F.col("at") / 50).alias("batch"), (F.col("at") % 50 + 1).alias("n"))
    said = F.when(F.col("doc_id") % 7 == 0, F.lit(" ")).otherwise(F.concat(F.lit("T:"), F.replace("title", F.lit("e"), F.lit("E"))))  # stands for the model
    lines = F.sort_array(F.collect_list(F.struct("n", F.concat(F.lit("["), F.col("n").cast("string"), F.lit("] "), said).alias("line"))))
    answers = asked.groupBy("batch").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("answer"))
    parts = answers.select("batch", F.explode(F.regexp_extract_all("answer", F.lit(r"(?m)^\[[0-9]+\][^\n]*"), F.lit(0))).alias("line"))
    back = parts.select("batch", F.regexp_extract("line", r"^\[([0-9]+)\]", 1).cast("long").alias("n"), F.trim(F.regexp_replace("line", r"^\[[0-9]+\] ?", "")).alias("new"))
    new = asked.join(back.where("new <> ''"), ["batch", "n"]).select("doc_id", "new")
    return t.join(new, "doc_id", "left").select("doc_id", F.coalesce("new", "title").alias("title"))
