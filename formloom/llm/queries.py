"""The queries op1 to op10 over the driver's tables, with production parameters, and their SQL.

Each is thin: it hands whole tables to its operator and derives the columns asked for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.llm import ann, chat, flac, langid, lm, mixing, packing, simhash, toxicity, urlfilter
from formloom.llm.common import cut, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.digests(flac.media(table(spark, sf_dir, "documents")))


def op5_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables have neither fetch times nor lists: both are derived from all pages by fixed rules."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 7919 % 17520 * 3600))
    hosts = pages.select(F.regexp_extract("url", "^[a-z]+://([^/?#:@]+)", 1).alias("host")).where("host <> ''").distinct()
    n = F.conv(F.substring(F.md5(F.col("host").cast("binary")), 1, 6), 16, 10).cast("long")
    dated = hosts.withColumn("n", n)
    at = lambda days: F.timestamp_seconds(F.lit(1704067200) + days * 86400)
    entry = lambda list_, verdict, pattern, days, action: F.struct(
        F.lit(list_).alias("list"), F.lit(verdict).alias("verdict"), pattern.alias("pattern"), at(days).alias("since"), F.lit(action).alias("action")
    )
    start, host, none = F.col("n") % 365, F.col("host"), F.array().cast("array<struct<list:string,verdict:string,pattern:string,since:timestamp,action:string>>")
    made = F.concat(
        F.when(F.col("n") % 3 == 0, F.array(entry("spam", "deny", host, start, "add"), entry("spam", "deny", host, start + 60, "remove"), entry("spam", "deny", host, start + 200, "add"))).otherwise(none),
        F.when(F.col("n") % 5 == 0, F.array(entry("trusted", "allow", host, start + 100, "add"), entry("trusted", "allow", host, start + 300, "remove"))).otherwise(none),
        F.when(F.col("n") % 2 == 0, F.array(entry("sections", "deny", F.concat(host, F.lit("/en")), start, "add"))).otherwise(none),
    )
    entries = dated.select(F.explode(made).alias("e")).select("e.*")
    top = spark.createDataFrame([("parents", "deny", "example.org", 400, "add"), ("parents", "deny", "example.org", 500, "remove")], "list string, verdict string, pattern string, days int, action string")
    return urlfilter.filter_captures(captures, entries.unionByName(top.withColumn("since", at(F.col("days"))).drop("days")))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.sql(f"SELECT -1L AS conv_id, turn, role, '{said}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.digests(chat.format_chats(turns))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sums of logarithms differ in their last digits with the order of the sum
    return lm.backoff_scores(table(spark, sf_dir, "documents")).withColumns({c: F.round(c, 4) for c in ("log_score", "perplexity")})


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(packing.items(table(spark, sf_dir, "documents"), near=True), "items")
    return packing.pack(rows, rows.count())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op3_simhash": op3_simhash,
    "op4_flac": op4_flac,
    "op5_urlfilter": op5_urlfilter,
    "op6_chat": op6_chat,
    "op7_ann": op7_ann,
    "op8_langid": op8_langid,
    "op9_lm": op9_lm,
    "op10_packing": op10_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op2_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS most,
         CAST(sum(source_size) OVER () AS BIGINT) AS total
  FROM named
), levels AS (
  SELECT *, CAST(coalesce(sum(most) OVER (ORDER BY CAST(most AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before,
         CAST(sum(weight) OVER (ORDER BY CAST(most AS DOUBLE) / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS after
  FROM weighed
), shares AS (
  SELECT *, CAST(total - before AS DOUBLE) / after AS share FROM levels
), level AS (
  SELECT arg_min(share, CAST(most AS DOUBLE) / weight) AS share FROM shares WHERE share * weight <= most
), goals AS (
  SELECT source, source_size, least(coalesce(weight * (SELECT share FROM level), CAST(most AS DOUBLE)), CAST(most AS DOUBLE)) AS target FROM shares
), placed AS (
  SELECT s.doc_id, s.source, s.size, g.source_size, g.target, CAST(floor(g.target + 0.5) AS BIGINT) AS words,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - s.size AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0
            ELSE size * (words // source_size) + least(size, greatest(0, words % source_size - start)) END AS BIGINT) AS taken,
       source
FROM placed
""",
    "op5_urlfilter": r"""
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_hours(CAST(page_id * 7919 % 17520 AS INT)) AS fetched_at,
         nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '.'), '') AS host,
         regexp_extract(url, '^[^:]+://[^/?#]*(/[^?#]*)', 1) AS path
  FROM pages
), hosts AS (
  SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/?#:@]+)', 1) AS host FROM pages
), dated AS (
  SELECT host, CAST('0x' || substr(md5(host), 1, 6) AS BIGINT) AS n FROM hosts WHERE host <> ''
), entries AS (
  SELECT 'spam' AS list, 'deny' AS verdict, host AS pattern, n % 365 AS day, 'add' AS action FROM dated WHERE n % 3 = 0
  UNION ALL SELECT 'spam', 'deny', host, n % 365 + 60, 'remove' FROM dated WHERE n % 3 = 0
  UNION ALL SELECT 'spam', 'deny', host, n % 365 + 200, 'add' FROM dated WHERE n % 3 = 0
  UNION ALL SELECT 'trusted', 'allow', host, n % 365 + 100, 'add' FROM dated WHERE n % 5 = 0
  UNION ALL SELECT 'trusted', 'allow', host, n % 365 + 300, 'remove' FROM dated WHERE n % 5 = 0
  UNION ALL SELECT 'sections', 'deny', host || '/en', n % 365, 'add' FROM dated WHERE n % 2 = 0
  UNION ALL SELECT 'parents', 'deny', 'example.org', 400, 'add'
  UNION ALL SELECT 'parents', 'deny', 'example.org', 500, 'remove'
), spans AS (
  SELECT *, lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS until FROM entries
), hits AS (
  SELECT c.page_id, c.url, c.fetched_at, s.verdict, s.list
  FROM captures c JOIN spans s
    ON s.action = 'add' AND c.fetched_at >= TIMESTAMP '2024-01-01' + to_days(CAST(s.day AS INT))
   AND (s.until IS NULL OR c.fetched_at < TIMESTAMP '2024-01-01' + to_days(CAST(s.until AS INT)))
   AND (c.host = s.pattern OR ends_with(c.host, '.' || s.pattern) OR starts_with(c.host || lower(regexp_replace(c.path, '/*$', '')) || '/', s.pattern || '/') AND contains(s.pattern, '/'))
), summed AS (
  SELECT page_id, url, fetched_at,
         coalesce(string_agg(DISTINCT CASE WHEN verdict = 'deny' THEN list END, ',' ORDER BY CASE WHEN verdict = 'deny' THEN list END), '') AS denied_by,
         coalesce(string_agg(DISTINCT CASE WHEN verdict = 'allow' THEN list END, ',' ORDER BY CASE WHEN verdict = 'allow' THEN list END), '') AS allowed_by
  FROM hits GROUP BY page_id, url, fetched_at
)
SELECT c.page_id, c.url, c.fetched_at, c.host, coalesce(s.denied_by, '') AS denied_by, coalesce(s.allowed_by, '') AS allowed_by,
       CASE WHEN c.host IS NULL THEN 'invalid' WHEN coalesce(s.denied_by, '') <> '' AND coalesce(s.allowed_by, '') = '' THEN 'drop' ELSE 'keep' END AS verdict
FROM captures c LEFT JOIN summed s ON c.page_id = s.page_id AND c.url = s.url
""",
    "op6_chat": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         length(text) + len(regexp_extract_all(text, '[<\[\\]')) AS escaped,
         CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
              ELSE 19 + length(role) + len(regexp_extract_all(role, '[<\[\\]')) END AS around
  FROM turns
), moves AS (
  SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 'start') AS before,
         row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS from_end
  FROM sized
), judged AS (
  SELECT *, before || '>' || role IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user') AS ok FROM moves
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(escaped + around) AS BIGINT) AS formatted_chars,
       coalesce(arg_min('turn ' || (i - 1) || ': ' || role || ' after ' || before, i) FILTER (NOT ok),
                max('ends with ' || role) FILTER (from_end = 1 AND role <> 'assistant')) IS NULL AS valid,
       coalesce(arg_min('turn ' || (i - 1) || ': ' || role || ' after ' || before, i) FILTER (NOT ok),
                max('ends with ' || role) FILTER (from_end = 1 AND role <> 'assistant')) AS problem
FROM judged GROUP BY conv_id
""",
    # exact search: what op7 gives where its least number of rows is the whole table, and what its recall is held against elsewhere
    "op7_ann": r"""
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id, max(list_inner_product(a.e, b.e)) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id GROUP BY ALL
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
""",
    "op9_lm": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), spots AS (
  SELECT r, len(ws) AS n, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w FROM docs
), grams AS (
  SELECT *, lag(w) OVER s || ' ' || w AS g2, lag(w, 2) OVER s || ' ' || lag(w) OVER s || ' ' || w AS g3 FROM spots WINDOW s AS (PARTITION BY r ORDER BY i)
), free AS (
  SELECT r, n, i, (SELECT count(*) FROM spots) - n AS rest,
         count(*) OVER (PARTITION BY w) - count(*) OVER (PARTITION BY r, w) AS f1,
         CASE WHEN i >= 2 THEN count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY r, g2) ELSE 0 END AS f2,
         CASE WHEN i >= 3 THEN count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY r, g3) ELSE 0 END AS f3
  FROM grams
), known AS (
  SELECT *, lag(f1) OVER s AS p1, lag(f2) OVER s AS p2, least(i, 3) AS top FROM free WINDOW s AS (PARTITION BY r ORDER BY i)
), scored AS (
  SELECT r, sum(CASE WHEN f3 > 0 THEN ln(f3) - ln(p2) WHEN f2 > 0 THEN ln(f2) - ln(p1) + (top - 2) * ln(0.4::DOUBLE)
                     WHEN f1 > 0 THEN ln(f1) - ln(rest) + (top - 1) * ln(0.4::DOUBLE) ELSE top * ln(0.4::DOUBLE) - ln(rest + 1) END) AS log_score,
         count_if(f3 > 0) AS seen
  FROM known GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, round(coalesce(log_score, 0), 4) AS log_score,
       CASE WHEN len(ws) > 0 THEN round(exp(-log_score / len(ws)), 4) END AS perplexity, CAST(coalesce(seen, 0) AS BIGINT) AS seen,
       CASE WHEN len(ws) >= 3 THEN seen / CAST(len(ws) - 2 AS DOUBLE) END AS seen_share
FROM docs LEFT JOIN scored USING (r)
""",
}
