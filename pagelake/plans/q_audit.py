"""Queries over quality and audit: rejects, retries, failure streaks,
cursor reports, routing; and the sinks (written, then read back)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.operators import audit as au
from pagelake.operators import extract as ex
from pagelake.operators import links as ln
from pagelake.plans import fixtures as fx
from pagelake.plans import sql as S
from pagelake.plans.q_feed import status_pages
from pagelake.plans.q_pages import comment_pages, feed_pages, profile_pages, topic_pages
from pagelake.plans.registry import ORACLE, query
from pagelake.schemas import TABLE_TAGS
from pagelake.session import fresh_dir
from pagelake.sinks import tables as sk
from pagelake.sources.pages import read_pages

REJECTS_SQL = S.with_(S.POSTS, S.COMMENTS, S.PROFILES, """
r AS (
  SELECT 'statuses' AS source_table, 'bad_created_at' AS reason FROM posts WHERE bad_date
  UNION ALL SELECT 'statuses', 'missing_field' FROM posts WHERE no_text
  UNION ALL SELECT 'comments', 'missing_field' FROM citems WHERE l_tax = 0
  UNION ALL SELECT 'comments', 'user_not_object' FROM citems WHERE l_tax <> 0 AND l_discount = 0
  UNION ALL SELECT 'profiles', 'missing_field' FROM prof WHERE c_acctbal < 0
  UNION ALL SELECT 'raw_pages', 'no_cursor' FROM (
    SELECT DISTINCT l_orderkey, page_no FROM citems WHERE page_no > 0 AND no_cursor))
SELECT source_table, reason, count(*) AS n FROM r GROUP BY 1, 2""")


STATUS_KEY = "'status_list:' || user_id || ':' || page_no"


@query("quarantine", S.with_(S.POSTS, S.COMMENTS, S.PROFILES, f"""
r AS (
  SELECT 'statuses' AS source_table, {STATUS_KEY} AS page_key, pos, 'bad_created_at' AS reason FROM posts WHERE bad_date
  UNION ALL SELECT 'statuses', {STATUS_KEY}, pos, 'missing_field' FROM posts WHERE no_text
  UNION ALL SELECT 'comments', {S.COMMENT_KEY}, pos, CASE WHEN l_tax = 0 THEN 'missing_field' ELSE 'user_not_object' END
    FROM citems WHERE l_tax = 0 OR l_discount = 0
  UNION ALL SELECT 'profiles', page_key, NULL, 'missing_field' FROM prof WHERE c_acctbal < 0
  UNION ALL SELECT DISTINCT 'raw_pages', {S.COMMENT_KEY}, CAST(NULL AS BIGINT), 'no_cursor' FROM citems WHERE page_no > 0 AND no_cursor)
SELECT source_table, page_key, pos, reason FROM r"""))
def q_quarantine(spark, sf):
    """G1: rejected pages, cards, comments and profiles with their place and reason."""
    return au.quarantine(fx.landed(spark, sf)).drop("payload")


@query("refused_records", S.with_(S.POSTS, S.COMMENTS, S.PROFILES, f"""
r AS (
  SELECT {STATUS_KEY} AS page_key, pos, 'text' AS unset FROM posts WHERE no_text
  UNION ALL SELECT {S.COMMENT_KEY}, pos, 'like_count' FROM citems WHERE l_tax = 0
  UNION ALL SELECT page_key, NULL, 'description' FROM prof WHERE c_acctbal < 0)
SELECT page_key, pos, unset FROM r"""))
def q_refused_records(spark, sf):
    """G4 by key presence: records with an unset field (a field given as JSON null is set)."""
    pages = fx.landed(spark, sf, ["profile", "status_list", "hot_comments"])
    found = [au.refused_records(pages, kind) for kind in ("profile", "status_list", "hot_comments")]
    return reduce(DataFrame.unionByName, found).select("page_key", "pos", F.array_join("unset", "|").alias("unset"))


@query("reject_counts", REJECTS_SQL)
def q_reject_counts(spark, sf):
    """Rejects counted by table and reason."""
    return au.reject_counts(au.quarantine(fx.landed(spark, sf)))


@query("write_rejects", ORACLE["quarantine"])
def q_write_rejects(spark, sf):
    """Rejects appended to their own table and read back."""
    path = fresh_dir(spark, "rejects")
    sk.write_rejects(au.quarantine(fx.landed(spark, sf)), path)
    return spark.read.parquet(path).select("source_table", "page_key", "pos", "reason")


@query("retry_backlog", S.with_(S.FETCHES, f"""
last AS (SELECT request_url, max(attempt) AS attempts, arg_max(http_status, attempt) AS last_status
         FROM fetches GROUP BY 1)
SELECT request_url, attempts, last_status, CAST(13 - attempts AS INTEGER) AS retries_left FROM last
WHERE last_status IN ({', '.join(map(str, au.RETRY_CODES))}) AND attempts <= {au.MAX_RETRIES}"""))
def q_retry_backlog(spark, sf):
    """URLs whose latest try failed with a retryable status and that have tries left."""
    log = fx.landed_fetches(spark, sf)
    return au.retry_backlog(log).select("request_url", "attempts", "last_status", "retries_left")


@query("error_streaks", S.with_(S.FETCHES, """
f AS (SELECT user_id, ts, page_key, http_status <> 200 AS failed,
             sum(CASE WHEN http_status = 200 THEN 1 ELSE 0 END) OVER (
               PARTITION BY user_id ORDER BY ts, page_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
      FROM fetches)
SELECT CAST(user_id AS VARCHAR) AS seed_key, CAST(run AS BIGINT) AS run, min(ts) AS first_at, max(ts) AS last_at,
       count(*) AS length
FROM f WHERE failed GROUP BY 1, 2 HAVING count(*) >= 15"""))
def q_error_streaks(spark, sf):
    """Runs of 15 or more failed fetches in a row, per account."""
    return au.error_streaks(fx.landed_fetches(spark, sf))


@query("missing_cursor_report", S.with_(S.POSTS, """
u AS (SELECT DISTINCT user_id FROM posts)
SELECT 'status_list' AS kind, 'no_since_id' AS reason, count(*) AS n_pages FROM u
UNION ALL
SELECT 'topic_name', 'no_ok', count(DISTINCT p_brand) FROM part
WHERE CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) >= 23"""))
def q_missing_cursor_report(spark, sf):
    """Pages lacking ``cardlistInfo``/``since_id`` or ``ok``, counted."""
    return au.missing_cursor_report(fx.landed(spark, sf))


def tagged_records(spark, sf) -> DataFrame:
    """Every record kind with its table tag, as ``(type, key)`` rows."""
    parts = [
        ex.tag_type(ex.extract_profiles(profile_pages(spark, sf)).select(F.col("page_key").alias("key")),
                    TABLE_TAGS["profiles"]),
        ex.tag_type(ex.extract_statuses(status_pages(spark, sf)).select(F.col("status_id").alias("key")),
                    TABLE_TAGS["statuses"]),
        ex.tag_type(ex.extract_comments(comment_pages(spark, sf)).select(F.col("page_key").alias("key")),
                    TABLE_TAGS["comments"]),
        ex.tag_type(ex.extract_supertopic_posts(feed_pages(spark, sf)).select(F.col("cid").alias("key")),
                    TABLE_TAGS["supertopic_posts"]),
        ex.tag_type(ex.extract_topics(topic_pages(spark, sf)).select(F.col("item_id").alias("key")),
                    TABLE_TAGS["topics"]),
    ]
    return reduce(DataFrame.unionByName, parts)


ROUTE_SQL = S.with_(S.POSTS, S.COMMENTS, S.PROFILES, f"""
t AS (
  SELECT 'weibouseritem' AS type, count(*) AS n FROM prof WHERE c_acctbal >= 0
  UNION ALL SELECT 'weibostatusitem', count(*) FROM posts WHERE {S.GOOD_POST}
  UNION ALL SELECT 'weibocommentitem', count(*) FROM citems WHERE good AND NOT (page_no > 0 AND no_cursor)
  UNION ALL SELECT 'weibochaohuaitem', count(*) FROM documents
  UNION ALL SELECT 'weibotopicitem', count(*) FROM part)
SELECT type, CASE type WHEN 'weibocommentitem' THEN 'comments' WHEN 'weibouseritem' THEN 'people'
                  ELSE 'statuses' END AS route, n FROM t""")


@query("route_records", ROUTE_SQL)
def q_route_records(spark, sf):
    """Records to three outputs by tag: comments, people, everything else."""
    routed = ln.route_records(tagged_records(spark, sf))
    return routed.groupBy("type", "route").agg(F.count(F.lit(1)).alias("n"))


@query("tag_type", ROUTE_SQL.replace("SELECT type, CASE type WHEN 'weibocommentitem' THEN 'comments' WHEN "
                                     "'weibouseritem' THEN 'people'\n                  ELSE 'statuses' END AS route, n FROM t",
                                     "SELECT type, n FROM t"))
def q_tag_type(spark, sf):
    """Constant table tag per record kind, counted."""
    return tagged_records(spark, sf).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- sinks and the landing reader

PAGE_COUNTS_SQL = S.with_(S.POSTS, S.COMMENTS, S.PROFILES, S.DOCS, S.PARTS, """
k AS (
  SELECT 'status_list' AS kind, count(DISTINCT (user_id, page_no)) AS n FROM posts
  UNION ALL SELECT 'profile', count(*) FROM prof
  UNION ALL SELECT 'hot_comments', count(DISTINCT (l_orderkey, page_no)) FROM citems
  UNION ALL SELECT 'supertopic', (SELECT count(*) FROM dpages) + (SELECT count(*) FROM dlast)
  UNION ALL SELECT 'topic_name', count(DISTINCT p_brand) FROM part
  UNION ALL SELECT 'topic_search', (SELECT count(*) FROM tpages) + (SELECT count(*) FROM tlast))
SELECT kind, n AS n_pages FROM k""")


@query("read_pages", PAGE_COUNTS_SQL)
def q_read_pages(spark, sf):
    """Landed pages written as JSON lines, read back with the fixed schema, counted by kind."""
    path = fresh_dir(spark, "landing")
    fx.landed(spark, sf).write.option("compression", "gzip").json(path)
    pages = read_pages(spark, path, fmt="json")
    return pages.groupBy("kind").agg(F.count(F.lit(1)).alias("n_pages"))


@query("write_jsonl", S.with_(S.POSTS, S.PROFILES, f"""
k AS (
  SELECT 'profiles' AS kind, CAST(c_custkey AS VARCHAR) AS id, c_mktsegment || ' buyer' AS text FROM prof WHERE c_acctbal >= 0
  UNION ALL SELECT 'statuses', CAST(oid AS VARCHAR), o_orderpriority || ' / ' || o_orderstatus FROM posts WHERE {S.GOOD_POST}
  UNION ALL SELECT 'supertopic_posts', CAST(doc_id AS VARCHAR), text FROM documents)
SELECT kind, id, text FROM k"""))
def q_write_jsonl(spark, sf):
    """One JSON-lines folder per record kind, read back: each record's id and whole text."""
    records = {
        "profiles": ex.extract_profiles(profile_pages(spark, sf)).withColumnsRenamed({"user_id": "id", "description": "text"}),
        "statuses": ex.extract_statuses(status_pages(spark, sf)).withColumnRenamed("status_id", "id"),
        "supertopic_posts": ex.extract_supertopic_posts(feed_pages(spark, sf)).withColumnRenamed("cid", "id"),
    }
    written = sk.write_jsonl(records, fresh_dir(spark, "jsonl"))
    read = [spark.read.schema(records[k].schema).json(p).select(F.lit(k).alias("kind"), F.col("id").cast("string").alias("id"), "text")
            for k, p in written.items()]
    return reduce(DataFrame.unionByName, read)


@query("append_table", S.with_(S.POSTS, f"""
SELECT CAST(oid AS VARCHAR) AS status_id, CAST(2 AS BIGINT) AS n_copies FROM posts WHERE {S.GOOD_POST}"""))
def q_append_table(spark, sf):
    """Two appends of the same records keep both copies (no key, as in the original sink)."""
    path = fresh_dir(spark, "statuses-table")
    st = ex.extract_statuses(status_pages(spark, sf)).withColumn("fetched_at", F.lit(fx.LANDED_AT).cast("timestamp"))
    sk.append_table(st, path)
    sk.append_table(st, path)
    return spark.read.parquet(path).groupBy("status_id").agg(F.count(F.lit(1)).alias("n_copies"))


@query("create_tables", S.with_(S.PROFILES, f"""
SELECT {S.PROFILE_COLS} FROM prof WHERE c_acctbal >= 0"""))
def q_create_tables(spark, sf):
    """Empty typed tables created from the record schemas, then profiles inserted into one."""
    loc = fresh_dir(spark, "tables")
    db = "pagelake_" + loc.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{loc}/db'")
    sk.create_tables(spark, loc, database=db, tables=["profiles"])
    prof = ex.extract_profiles(profile_pages(spark, sf))
    cols = [f.name for f in spark.table(f"{db}.profiles").schema.fields]
    prof.select(*cols).write.insertInto(f"{db}.profiles")
    return spark.table(f"{db}.profiles")
