"""Queries of tags, the delivery queue and the schedule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scores import backoff as backoff_of
from tidemark.operators import delivery
from tidemark.operators import transitions as T
from tidemark.plans.catalog import query
from tidemark.sources import tables as S
from tidemark.sources.tables import with_

#: The end of the test data's orders, as the queue's clock.
NOW = 996_600_000


@query(with_("tag_results", body=" SELECT item_id, arg_max(tag, (score, -tag_id)) AS tag, round(max(score), 6) AS score FROM tag_results GROUP BY 1"))
def best_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-23, AI-3: an item's tag of the highest score, the first of equals; scores are clamped to 0..1."""
    t = S.tag_results(spark, sf_dir).withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("score", F.lit(0.5)))))
    return t.groupBy("item_id").agg(F.max_by("tag", F.struct("score", -F.col("tag_id"))).alias("tag"), F.round(F.max("score"), 6).alias("score"))


@query(with_("tag_results", "titles_doc", body=""", x AS (SELECT r.tag_id, r.tag, d.title, r.score, row_number() OVER (PARTITION BY r.tag_id, d.title ORDER BY r.score DESC, r.item_id) AS k FROM tag_results r JOIN titles_doc d ON d.doc_id = r.item_id WHERE r.score >= 0.5)
SELECT tag_id, tag, count(*) AS n, min(title) AS first_title FROM x WHERE k = 1 GROUP BY 1, 2"""))
def tag_regroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-22, RP-7, FL-9, OR-4: tags with their titles, each once."""
    x = S.tag_results(spark, sf_dir).where("score >= 0.5").join(S.titles_doc(spark, sf_dir), F.col("doc_id") == F.col("item_id"))
    w = Window.partitionBy("tag_id", "title").orderBy(F.desc("score"), "item_id")
    return x.withColumn("k", F.row_number().over(w)).where("k = 1").groupBy("tag_id", "tag").agg(F.count("*").alias("n"), F.min("title").alias("first_title"))


@query(with_("titles_doc", body=" SELECT doc_id, source_id FROM titles_doc WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)"))
def pending_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-9: items that the ledger of analysed ones lacks."""
    return S.titles_doc(spark, sf_dir).join(S.table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti").select("doc_id", "source_id")


@query(with_("tag_results", body=" SELECT item_id, tag_id, CASE WHEN version < 2 AND tag_id = 2 THEN 'deprecated' ELSE 'active' END AS status FROM tag_results"))
def tag_deprecate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-10, ST-11: results of tags that an older version withdrew are marked, not deleted."""
    t = S.tag_results(spark, sf_dir)
    gone = t.where("version < 2 and tag_id = 2").select("tag_id", "version").distinct().withColumn("status", F.lit("deprecated"))
    return t.join(gone, ["tag_id", "version"], "left").select("item_id", "tag_id", F.coalesce("status", F.lit("active")).alias("status"))


@query(with_("tag_results", "titles_doc", body=""" SELECT r.item_id, r.tag, d.title, coalesce(upper(d.source_id), '') AS source_name, 'hotlist' AS source_type FROM tag_results r JOIN titles_doc d ON d.doc_id = r.item_id WHERE r.tag_id = 1 AND r.score > 0
UNION ALL SELECT r.item_id, r.tag, d.title, d.source_id, 'rss' FROM tag_results r JOIN titles_doc d ON d.doc_id = r.item_id WHERE r.tag_id = 2 AND r.score > 0"""))
def tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-5, JN-6, SO-7: results of both kinds of source with their items."""
    x = S.tag_results(spark, sf_dir).where("score > 0").join(S.titles_doc(spark, sf_dir), F.col("doc_id") == F.col("item_id"))
    hot = x.where("tag_id = 1").select("item_id", "tag", "title", F.coalesce(F.upper("source_id"), F.lit("")).alias("source_name"), F.lit("hotlist").alias("source_type"))
    return hot.unionByName(x.where("tag_id = 2").select("item_id", "tag", "title", F.col("source_id").alias("source_name"), F.lit("rss").alias("source_type")))


@query(with_("tag_results", body=" SELECT tag_id, coalesce(max(version), 0) AS latest, count(DISTINCT item_id) AS items, count(*) FILTER (score = 0) AS unmatched FROM tag_results GROUP BY 1"))
def tag_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-26, ST-12, ST-13: the latest version of each tag, its items, and those that a cleared ledger would give back."""
    return S.tag_results(spark, sf_dir).groupBy("tag_id").agg(F.coalesce(F.max("version"), F.lit(0)).alias("latest"), F.count_distinct("item_id").alias("items"), F.count_if(F.col("score") == 0).alias("unmatched"))


@query(with_("articles", body=" SELECT publisher, status, count(*) AS n FROM articles GROUP BY 1, 2"))
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-24."""
    return S.articles(spark, sf_dir).groupBy("publisher", "status").agg(F.count("*").alias("n"))


@query(with_("articles", body=" SELECT publisher, count(DISTINCT CASE WHEN document_id <> '' THEN document_id END) + count(*) FILTER (document_id = '' AND status = 'notified') AS occupied FROM articles GROUP BY 1"))
def occupied_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-25: distinct documents, and delivered articles that name none."""
    doc = F.col("document_id")
    return S.articles(spark, sf_dir).groupBy("publisher").agg((F.count_distinct(F.when(doc != "", doc)) + F.count_if((doc == "") & (F.col("status") == "notified"))).alias("occupied"))


_PRIORITY = "CASE status WHEN 'doc_created' THEN 0 WHEN 'fetched' THEN 1 WHEN 'fetch_pending' THEN 2 WHEN 'discovered' THEN 3 END"


@query(with_("articles", body=f" SELECT article_key, status FROM articles WHERE {_PRIORITY} IS NOT NULL AND next_at <= {NOW} ORDER BY {_PRIORITY}, discovered_at, article_key LIMIT 20"))
def work_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OX-3, OR-14: the next 20 articles to be worked on."""
    status = F.col("status")
    p = F.when(status == "doc_created", 0).when(status == "fetched", 1).when(status == "fetch_pending", 2).when(status == "discovered", 3)
    return S.articles(spark, sf_dir).withColumn("p", p).where(f"p is not null and next_at <= {NOW}").orderBy("p", "discovered_at", "article_key").limit(20).select("article_key", "status")


_LIMIT = 20_000


@query(with_("articles", body=f""", d AS (SELECT document_id, count(*) AS n FROM articles WHERE document_id <> '' GROUP BY 1), o AS (SELECT count(*) AS occupied FROM d),
c AS (SELECT a.article_key, a.discovered_at FROM articles a JOIN d USING (document_id) WHERE a.status = 'notified' AND d.n = 1), r AS (SELECT *, row_number() OVER (ORDER BY discovered_at, article_key) AS k FROM c)
SELECT article_key FROM r, o WHERE k <= greatest(occupied - {_LIMIT // 2}, 0)"""))
def retention_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OX-9, OR-15, JN-18: the oldest delivered articles, with documents of their own, that exceed the limit."""
    a = S.articles(spark, sf_dir)
    d = a.where("document_id <> ''").groupBy("document_id").agg(F.count("*").alias("n"))
    excess = max(0, d.count() - _LIMIT // 2)
    return a.where("status = 'notified'").join(d.where("n = 1"), "document_id").orderBy("discovered_at", "article_key").limit(excess).select("article_key")


@query(with_("articles", body=f" SELECT article_key FROM articles a WHERE status = 'shared' AND next_at <= {NOW} AND (document_id = '' OR NOT EXISTS (SELECT 1 FROM articles p WHERE p.document_id = a.document_id AND p.publisher = a.publisher AND (p.status <> 'shared' OR p.next_at > {NOW})))"))
def message_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OX-7, JN-18: shared articles that are due, and so are all that go with them in a message."""
    a = S.articles(spark, sf_dir)
    late = a.where(f"document_id <> '' and (status <> 'shared' or next_at > {NOW})").select("document_id", "publisher").distinct()
    return a.where(f"status = 'shared' and next_at <= {NOW}").join(late, ["document_id", "publisher"], "left_anti").select("article_key")


@query(with_("articles", body=f" SELECT article_key, discovered_at + least(21600, 60 * (1 << least(failures, 8)))::BIGINT AS retry_at, CASE WHEN failures >= 8 THEN 'manual' ELSE status END AS status FROM articles WHERE failures > 0"))
def backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OX-5, OX-6: when a failed article is tried again; after eight failures it is left to people."""
    return S.articles(spark, sf_dir).where("failures > 0").select("article_key", (F.col("discovered_at") + backoff_of(F.col("failures"))).alias("retry_at"), F.when(F.col("failures") >= 8, "manual").otherwise(F.col("status")).alias("status"))


@query(with_("articles", body=", r AS (SELECT *, row_number() OVER (PARTITION BY publisher, document_id ORDER BY discovered_at, article_key) AS k FROM articles WHERE document_id <> '') SELECT article_key, k = 1 AS owner FROM r"))
def canonical_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OX-4: the first article of a document owns it."""
    w = Window.partitionBy("publisher", "document_id").orderBy("discovered_at", "article_key")
    return S.articles(spark, sf_dir).where("document_id <> ''").select("article_key", (F.row_number().over(w) == 1).alias("owner"))


#: What an event of the test data asks for, by its type and its number k.
_ASKS = "CASE event_type WHEN 'view' THEN CASE WHEN k < 50 THEN 'ask' ELSE 'fetch' END WHEN 'click' THEN CASE WHEN k < 50 THEN 'fetch' ELSE 'create' END WHEN 'signup' THEN CASE WHEN k < 30 THEN 'advance' WHEN k < 60 THEN 'create' ELSE 'share' END WHEN 'purchase' THEN CASE WHEN k < 60 THEN 'share' ELSE 'notify' END ELSE CASE WHEN k < 85 THEN 'retry' WHEN k < 92 THEN 'lose' ELSE 'stop' END END"
_ALLOWED = "(VALUES " + ", ".join(f"('{n}', '{s}', '{c.to or s}', {c.fails}, {c.clears})" for n, c in T.COMMANDS.items() for s in c.allowed) + ") AS g(command, here, next, fails, clears)"


@query(f"""WITH RECURSIVE log AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no, {_ASKS} AS command FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) % 100 AS k FROM events)),
r AS (SELECT user_id, 0::BIGINT AS no, 'discovered' AS state, 0::BIGINT AS retries, 0::BIGINT AS failures, 0::BIGINT AS done, 0::BIGINT AS refused FROM log WHERE no = 1
UNION ALL SELECT l.user_id, l.no, coalesce(g.next, r.state), r.retries + CASE WHEN g.fails THEN 1 ELSE 0 END, CASE WHEN g.clears THEN 0 ELSE r.failures + CASE WHEN g.fails THEN 1 ELSE 0 END END, r.done + CASE WHEN g.here IS NULL THEN 0 ELSE 1 END, r.refused + CASE WHEN g.here IS NULL THEN 1 ELSE 0 END
FROM r JOIN log l ON l.user_id = r.user_id AND l.no = r.no + 1 LEFT JOIN {_ALLOWED} ON g.command = l.command AND g.here = r.state)
SELECT user_id AS article_key, state, retries, failures, done, refused FROM (SELECT *, max(no) OVER (PARTITION BY user_id) AS last FROM r) WHERE no = last""")
def guarded_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OX-1, OX-5: an article's state after all commands of its log; those that come in the wrong state are refused, and terminal states stay."""
    e = S.table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int") % 100)
    command = F.array_position(F.array(*map(F.lit, T.NAMES)), F.expr(_ASKS)).cast("int") - 1
    return T.states(e.select(F.col("user_id").alias("article_key"), "ts", "event_id", command.alias("command")), "article_key", ["ts", "event_id"], "command")


@query(with_("articles", body=" SELECT publisher, CAST(make_timestamp((discovered_at // 2592000) * 2592000 * 1000000) AS DATE)::VARCHAR AS month, count(*) AS n FROM articles WHERE article_key NOT IN (SELECT article_key FROM articles WHERE status = 'notified' AND failures < 3) GROUP BY 1, 2"))
def discovered_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OX-2: articles that the baseline lacks, by 30 days."""
    a = S.articles(spark, sf_dir)
    base = a.where("status = 'notified' and failures < 3").select("article_key")
    month = F.to_date(F.timestamp_seconds(F.floor(F.col("discovered_at") / 2592000) * 2592000)).cast("string")
    return a.join(base, "article_key", "left_anti").groupBy("publisher", month.alias("month")).agg(F.count("*").alias("n"))


@query(with_("articles", body=f" SELECT publisher, count(*) FILTER (failures >= 6) AS failing, count(*) FILTER (failures >= 6) * 10 > count(*) * 3 AS open, max(next_at) FILTER (failures >= 6) AS retry_at FROM articles WHERE status <> 'notified' GROUP BY 1"))
def circuit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OX-10: a publisher's circuit opens if over three tenths of its open articles fail again and again."""
    bad = F.col("failures") >= 6
    return S.articles(spark, sf_dir).where("status <> 'notified'").groupBy("publisher").agg(F.count_if(bad).alias("failing"), (F.count_if(bad) * 10 > F.count("*") * 3).alias("open"), F.max(F.when(bad, F.col("next_at"))).alias("retry_at"))


_COOLDOWN = 6 * 3600


@query(f"""WITH RECURSIVE f AS (SELECT user_id % 25 AS kind, event_id, epoch(ts)::BIGINT AS t, row_number() OVER (PARTITION BY user_id % 25 ORDER BY epoch(ts)::BIGINT, event_id) AS no FROM events WHERE event_type = 'error'),
r AS (SELECT kind, event_id, t, no, t AS sent, TRUE AS sends FROM f WHERE no = 1 UNION ALL SELECT f.kind, f.event_id, f.t, f.no, CASE WHEN r.sent + {_COOLDOWN} <= f.t THEN f.t ELSE r.sent END, r.sent + {_COOLDOWN} <= f.t FROM r JOIN f ON f.kind = r.kind AND f.no = r.no + 1)
SELECT kind, event_id FROM r WHERE sends""")
def alerts_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OX-10: failures that an alert is sent for: none goes out within six hours of the one before."""
    e = S.table(spark, sf_dir, "events").where("event_type = 'error'")
    second = F.rint(F.unix_micros("ts") / 1_000_000).cast("long")  # the nearest, not the one before
    return delivery.spaced(e.select((F.col("user_id") % 25).alias("kind"), second.alias("t"), "event_id"), "kind", "t", ["event_id"], _COOLDOWN).select("kind", "event_id")


#: Periods of a day, the last across midnight.
PERIODS = [("morning", "06:00", "11:30"), ("noon", "11:30", "14:00"), ("evening", "18:00", "22:00"), ("night", "22:00", "06:00")]
_PERIODS = "(VALUES " + ", ".join(f"('{k}', '{a}', '{b}')" for k, a, b in PERIODS) + ") AS p(period_key, s, e)"


def _periods(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(PERIODS, "period_key string, s string, e string"))


@query(with_("obs", body=f" SELECT coalesce(period_key, 'default') AS period_key, count(*) AS n FROM obs LEFT JOIN {_PERIODS} ON CASE WHEN s <= e THEN s <= crawl_time AND crawl_time < e ELSE crawl_time >= s OR crawl_time < e END GROUP BY 1"))
def active_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-19, DT-9, SM-11: the period of each observation, by time of day and half-open."""
    t = F.col("crawl_time")
    inside = F.when(F.col("s") <= F.col("e"), (F.col("s") <= t) & (t < F.col("e"))).otherwise((t >= F.col("s")) | (t < F.col("e")))
    return S.obs(spark, sf_dir).join(_periods(spark), inside, "left").groupBy(F.coalesce("period_key", F.lit("default")).alias("period_key")).agg(F.count("*").alias("n"))


@query(with_("obs", body=f", x AS (SELECT o.*, coalesce(period_key, 'default') AS period_key FROM obs o LEFT JOIN {_PERIODS} ON CASE WHEN s <= e THEN s <= crawl_time AND crawl_time < e ELSE crawl_time >= s OR crawl_time < e END) SELECT CAST(crawl_date AS VARCHAR) AS day, period_key, strftime(min(crawl_ts), '%Y-%m-%d %H:%M') AS runs_at, count(DISTINCT crawl_ts) AS crawls FROM x GROUP BY crawl_date, period_key"))
def period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SM-11: what is done once in each period of a day is done at its first crawl; the ledger has that and how many crawls there were."""
    t = F.col("crawl_time")
    inside = F.when(F.col("s") <= F.col("e"), (F.col("s") <= t) & (t < F.col("e"))).otherwise((t >= F.col("s")) | (t < F.col("e")))
    crawls = S.obs(spark, sf_dir).select("crawl_date", "crawl_ts", "crawl_time").distinct()
    found = crawls.join(_periods(spark), inside, "left").groupBy("crawl_date", F.coalesce("period_key", F.lit("default")).alias("period_key"))
    return found.agg(F.date_format(F.min("crawl_ts"), "yyyy-MM-dd HH:mm").alias("runs_at"), F.count("*").alias("crawls")).select(F.col("crawl_date").cast("string").alias("day"), "period_key", "runs_at", "crawls")


_PLANS = [("a", "08:00", "12:00"), ("b", "11:00", "13:00"), ("c", "22:00", "02:00"), ("d", "01:00", "03:00"), ("e", "13:00", "14:00")]


@query("""WITH p(k, s, e) AS (VALUES """ + ", ".join(f"('{k}', '{a}', '{b}')" for k, a, b in _PLANS) + """), g AS (SELECT k, s, e FROM p WHERE s <= e UNION ALL SELECT k, s, '24:00' FROM p WHERE s > e UNION ALL SELECT k, '00:00', e FROM p WHERE s > e)
SELECT DISTINCT a.k AS period_a, b.k AS period_b FROM g a JOIN g b ON a.k < b.k AND a.s < b.e AND b.s < a.e""")
def period_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-20: periods of a plan that overlap; those across midnight are two."""
    p = spark.createDataFrame(_PLANS, "k string, s string, e string")
    g = p.where("s <= e").union(p.where("s > e").select("k", "s", F.lit("24:00"))).union(p.where("s > e").select("k", F.lit("00:00"), "e"))
    a, b = g.select(F.col("k").alias("period_a"), F.col("s").alias("s1"), F.col("e").alias("e1")), g.select(F.col("k").alias("period_b"), F.col("s").alias("s2"), F.col("e").alias("e2"))
    return a.join(b, (F.col("period_a") < F.col("period_b")) & (F.col("s1") < F.col("e2")) & (F.col("s2") < F.col("e1"))).select("period_a", "period_b").distinct()


_TURNS = r""" WITH l AS (SELECT conv_id, turn, i, s[i] AS line FROM (SELECT conv_id, turn, string_split('[1] ' || replace(text, '. ', chr(10) || '[2] '), chr(10)) AS s, unnest(range(1, len(string_split('[1] ' || replace(text, '. ', chr(10) || '[2] '), chr(10))) + 1)) AS i FROM conversations)),
n AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^\[[0-9]+\] ') THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, turn ORDER BY i) AS part FROM l)
SELECT conv_id, turn, part::BIGINT AS part, string_agg(regexp_replace(line, '^\[[0-9]+\] ', ''), ' ' ORDER BY i) AS body FROM n GROUP BY 1, 2, 3"""


@query(_TURNS)
def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX-19, AI-5: numbered parts of an answer; a line without a number goes on with the part before."""
    c = S.table(spark, sf_dir, "conversations")
    lines = c.select("conv_id", "turn", F.posexplode(F.split(F.concat(F.lit("[1] "), F.replace("text", F.lit(". "), F.lit("\n[2] "))), "\n")).alias("i", "line"))
    part = F.sum(F.when(F.col("line").rlike(r"^\[[0-9]+\] "), 1).otherwise(0)).over(Window.partitionBy("conv_id", "turn").orderBy("i"))
    own = F.struct("i", F.regexp_replace("line", r"^\[[0-9]+\] ", "").alias("t"))
    return lines.withColumn("part", part).groupBy("conv_id", "turn", "part").agg(F.array_join(F.transform(F.sort_array(F.collect_list(own)), lambda x: x["t"]), " ").alias("body"))
