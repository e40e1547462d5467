"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are the matches of three patterns, leftmost and without overlap within a kind (ENOUGH then drops short ones):

    assign  (password|passwd|secret|token|api_?key)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)    group 2 of 6 or more
    access  AKIA[A-Z0-9]+      20 or more characters
    hex     [0-9a-f]+          24 or more characters

The hash of each candidate's value is counted over the whole corpus by distinct repositories and owners. A value that
many owners have is a copied example; one of at most `owners` owners and `repos` repositories, if it also looks random,
is taken for a live credential, and its place is added as a span of kind `live`. Base spans stay in either case.

Cases: a null text is an empty one; a null owner or repository counts as one of its own. A null doc_id stays null;
repeated rows get equal results; an empty table gives no row; other columns are ignored. Offsets count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import cut, keyed, unkeyed

BASE_KINDS = ("assign", "access", "hex")
_WORDS = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
#: A run of the class is one match, so asking for the least length at once finds the same matches as dropping short ones.
PATTERNS = {
    "assign": rf"""({_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
}
#: Least characters of an assigned value: it may not be part of the pattern, as a short match uses up its text.
ENOUGH = 6
#: A value of more distinct owners or repositories is a copied example.
OWNERS, REPOS = 1, 2
#: What a random value has: characters, distinct characters, a letter and a digit; and what a stand-in has.
LONG, DISTINCT, STAND_IN = 12, 8, "(?i)example|sample|changeme|placeholder|x{4}|1234|abcd"
_CANDIDATE = "array<struct<start:int,no:int,kind:string,end:int,value_start:int,value:string>>"


def _found(text: Column, kind: str) -> Column:
    """Candidates of a kind. The text between matches and the matches, in turn, give their places."""
    pattern = F.lit(PATTERNS[kind])
    between = F.transform(F.split(text, PATTERNS[kind], -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    values = F.regexp_extract_all(text, pattern, F.lit(2 if kind == "assign" else 0))
    none = F.array().cast(_CANDIDATE)

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + m["between"]
        end = start + m["whole"]
        one = F.struct(start.alias("start"), F.lit(BASE_KINDS.index(kind)).alias("no"), F.lit(kind).alias("kind"), end.alias("end"), (end - F.length(m["value"])).alias("value_start"), m["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(F.length(m["value"]) >= ENOUGH, F.array_append(state["out"], one)).otherwise(state["out"]).alias("out"))

    # arrays_zip pads the shorter ones with a null: the text behind the last match
    matches = F.filter(F.arrays_zip(between.alias("between"), whole.alias("whole"), values.alias("value")), lambda m: m["whole"].isNotNull())
    return F.when(text.rlike(PATTERNS[kind]), F.aggregate(matches, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda s: s["out"])).otherwise(none)


def _random(value: Column) -> Column:
    return (F.length(value) >= LONG) & (F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(STAND_IN)


def find_secrets(docs: DataFrame, owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang"), owners: int = OWNERS, repos: int = REPOS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and live: arrays of (start, no, kind, end), in order."""
    same = lambda c: F.coalesce(docs[c].cast("string"), F.lit("\0"))
    rows = docs.select(docs[id_col], docs[text_col], same(owner_col).alias("_owner"), F.concat_ws("\1", *map(same, repo_cols)).alias("_repo"))
    rows = keyed(rows, id_col, text_col, "_owner", "_repo")
    any_kind = "|".join(f"(?:{PATTERNS[k]})" for k in BASE_KINDS)
    found = F.when(F.col("_text").rlike(any_kind), F.sort_array(F.concat(*[_found(F.col("_text"), k) for k in BASE_KINDS]))).otherwise(F.array().cast(_CANDIDATE))
    scanned = cut(rows.select("_id", F.xxhash64("_id", "_text").alias("_uid"), "_owner", "_repo", found.alias("found")))

    one = scanned.where(F.size("found") > 0).select("_uid", "_owner", "_repo", F.explode("found").alias("c"))
    one = one.select("_uid", "_owner", "_repo", F.sha2("c.value", 256).alias("hash"), "c.value_start", "c.end", _random(F.col("c.value")).alias("random")).where("random")
    held = one.select("hash", "_owner", "_repo").distinct().groupBy("hash").agg(F.count_distinct("_owner").alias("owners"), F.count_distinct("_repo").alias("repos"))
    own = held.where((F.col("owners") <= owners) & (F.col("repos") <= repos)).select("hash")
    live = one.join(own, "hash").groupBy("_uid").agg(F.collect_set(F.struct(F.col("value_start").alias("start"), F.lit(len(BASE_KINDS)).alias("no"), F.lit("live").alias("kind"), "end")).alias("live"))
    base = F.transform("found", lambda c: F.struct(c["start"].alias("start"), c["no"].alias("no"), c["kind"].alias("kind"), c["end"].alias("end")))
    none = F.array().cast("array<struct<start:int,no:int,kind:string,end:int>>")
    return scanned.join(live, "_uid", "left").select(unkeyed().alias("doc_id"), base.alias("base"), F.sort_array(F.coalesce("live", none)).alias("live"))


def secrets(docs: DataFrame, **more) -> DataFrame:
    """find_secrets with its counts, digest and the joined spans."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    every = F.sort_array(F.concat("base", "live"))
    return find_secrets(docs, **more).select("doc_id", *map(count, BASE_KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(every).alias("spans"))


def _sql() -> str:
    quoted = {k: v.replace("'", "''") for k, v in PATTERNS.items()}
    kinds = " UNION ALL ".join(
        f"SELECT uid, '{k}' AS kind, {i} AS no, regexp_extract_all(text, '{quoted[k]}', 0) AS m, regexp_extract_all(text, '{quoted[k]}', {2 if k == 'assign' else 0}) AS v, regexp_split_to_array(text, '{quoted[k]}') AS p FROM docs" for i, k in enumerate(BASE_KINDS)
    )
    joined = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, no, e), '')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text, coalesce(source, chr(1)) AS owner, coalesce(source, chr(1)) || chr(2) || coalesce(lang, chr(1)) AS repo FROM documents),
hits AS ({kinds}),
places AS (SELECT uid, kind, no, v[i] AS value,
    (list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s, length(m[i]) AS n
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM hits WHERE len(m) > 0)),
base AS (SELECT uid, kind, no, value, s, s + n AS e FROM places WHERE length(value) >= {ENOUGH}),
random AS (SELECT b.*, owner, repo FROM base b JOIN docs USING (uid) WHERE length(value) >= {LONG} AND len(list_distinct(string_split(value, ''))) >= {DISTINCT}
    AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND NOT regexp_matches(value, '{STAND_IN}')),
own AS (SELECT value FROM random GROUP BY value HAVING count(DISTINCT owner) <= {OWNERS} AND count(DISTINCT repo) <= {REPOS}),
live AS (SELECT DISTINCT uid, 'live' AS kind, {len(BASE_KINDS)} AS no, e - length(value) AS s, e FROM random JOIN own USING (value)),
told AS (SELECT uid, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)}, {joined} AS base FROM base GROUP BY uid),
every AS (SELECT uid, {joined} AS spans FROM (SELECT uid, kind, no, s, e FROM base UNION ALL SELECT uid, kind, no, s, e FROM live) GROUP BY uid)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in BASE_KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN told USING (uid) LEFT JOIN every USING (uid)"""


#: `secrets` of documents, in DuckDB's SQL.
ORACLE_SQL = _sql()
