"""Queries over requests as data: URL columns, next pages, missing pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelake.functions import urls as U
from pagelake.operators import extract as ex
from pagelake.operators import links as ln
from pagelake.operators import ordinal as od
from pagelake.operators import requests as rq
from pagelake.plans import fixtures as fx
from pagelake.plans import sql as S
from pagelake.plans.q_feed import status_pages
from pagelake.plans.q_pages import comment_pages, feed_pages, profile_pages, topic_pages
from pagelake.plans.registry import query


def _landed(spark, sf):
    return fx.landed(spark, sf)


@query("profile_request", f"SELECT c_custkey, {S.PROFILE} || c_custkey AS request_url FROM customer")
def q_profile_request(spark, sf):
    c = fx.table(spark, sf, "customer")
    return c.select("c_custkey", U.profile_request("c_custkey").alias("request_url"))


@query("status_list_request", S.with_(S.PROFILES, f"""
SELECT page_key, {S.PROFILE} || c_custkey || '&containerid=107603' || c_custkey AS request_url FROM prof"""))
def q_status_list_request(spark, sf):
    """Profile page URL + its post-list container."""
    p = profile_pages(spark, sf)
    return p.select("page_key", U.status_list_request("request_url", ex.extract_container_id("body"))
                    .alias("request_url"))


@query("next_status_page", S.with_(S.POSTS, f"""
SELECT 'status_list:' || user_id || ':' || page_no AS page_key,
       CASE WHEN page_no = (max(n_posts) - 1) // 10 THEN NULL
            ELSE {S.PROFILE} || user_id || '&containerid=107603' || user_id || '&since_id=' || min(oid) END AS next_url
FROM posts GROUP BY user_id, page_no"""))
def q_next_status_page(spark, sf):
    """Append or replace ``since_id``; none when the cursor is absent."""
    cur = ex.status_page_cursor(status_pages(spark, sf))
    return cur.select("page_key", U.next_status_page("request_url", "since_id").alias("next_url"))


@query("comment_request", S.with_(S.POSTS, f"""
SELECT CAST(oid AS VARCHAR) AS status_id, {S.COMMENT} || oid || '&mid=' || oid AS request_url
FROM posts WHERE {S.GOOD_POST}"""))
def q_comment_request(spark, sf):
    """Hot-comment URL of each post (id given twice)."""
    st = ex.extract_statuses(status_pages(spark, sf))
    return st.select("status_id", U.comment_request("status_id").alias("request_url"))


@query("next_comment_page", S.with_(S.COMMENTS, f"""
SELECT DISTINCT {S.COMMENT_KEY} AS page_key,
       CASE WHEN no_cursor OR last_page THEN NULL
            ELSE {S.COMMENT} || l_orderkey || '&mid=' || l_orderkey || '&max_id=' || (l_orderkey * 10 + page_no + 1)
                 || '&max_id_type=0' END AS next_url
FROM citems"""))
def q_next_comment_page(spark, sf):
    """Base URL + ``max_id`` + ``max_id_type``; none when ``max_id`` is 0 or absent."""
    cp = ex.comment_pages(comment_pages(spark, sf))
    return cp.select("page_key", U.next_comment_page("parent_status_id", "max_id", "max_id_type").alias("next_url"))


@query("next_supertopic_page", S.with_(S.DOCS, f"""
SELECT 'supertopic:100808' || source || ':' || page_no AS page_key,
       {S.FEED} || '100808' || source || '&since_id=' || (page_no + 1) AS next_url FROM dpages
UNION ALL SELECT 'supertopic:100808' || source || ':' || page_no, NULL FROM dlast"""))
def q_next_supertopic_page(spark, sf):
    """Same feed, next ``since_id``; none without a cursor."""
    p = feed_pages(spark, sf)
    since = F.get_json_object("body", "$.data.pageInfo.since_id")
    return p.select("page_key", U.next_supertopic_page("seed_key", since).alias("next_url"))


@query("topic_search_request", f"""
SELECT DISTINCT '100120' || regexp_extract(p_brand, '(\\d+)', 1) AS film_id,
  {S.CONTAINER} || '100103type%3D38%26q%3D' || replace(p_brand, '#', '%23') || '%26t%3D0'
  || '&page_type=searchall&page=1' AS request_url
FROM part""")
def q_topic_search_request(spark, sf):
    """Percent-encoded search URL for each film title, page 1."""
    t = ex.extract_topic_title(topic_pages(spark, sf))
    return t.select("film_id", U.topic_search_request("title", 1).alias("request_url"))


@query("dedupe_requests", S.with_(S.COMMENTS, f"""
req AS (
  SELECT {S.PROFILE} || l_suppkey AS request_url, 'profile' AS kind FROM citems WHERE good
  UNION ALL SELECT DISTINCT {S.CONTAINER} || '100120' || regexp_extract(p_brand, '(\\d+)', 1), 'topic_name' FROM part)
SELECT request_url, kind, count(*) AS n FROM req GROUP BY 1, 2"""))
def q_dedupe_requests(spark, sf):
    """Repeated URLs kept when ``dont_filter`` is set (commenter profiles), else once (film pages)."""
    items = ex.comment_items(comment_pages(spark, sf)).where(F.col("reject_reason").isNull())
    prof = items.select(U.profile_request("comment_people_id").alias("request_url"),
                        F.lit("profile").alias("kind"), F.lit(True).alias("dont_filter"))
    films = fx.table(spark, sf, "part").select(U.topic_name_request(fx.film_of(F.col("p_brand"))).alias("request_url"),
                                               F.lit("topic_name").alias("kind"), F.lit(False).alias("dont_filter"))
    out = rq.dedupe_requests(prof.unionByName(films))
    return out.groupBy("request_url", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("order_requests", f"""
WITH req AS (
  SELECT {S.PROFILE} || c_custkey AS request_url, 10 AS priority FROM customer
  UNION ALL SELECT {S.COMMENT} || o_orderkey || '&mid=' || o_orderkey, 0 FROM orders)
SELECT request_url, CAST(priority AS INTEGER) AS priority,
       CAST(row_number() OVER (ORDER BY priority DESC, request_url) - 1 AS BIGINT) AS queue_pos FROM req""")
def q_order_requests(spark, sf):
    """Higher priority first, as a positioned queue table."""
    prof = fx.table(spark, sf, "customer").select(U.profile_request("c_custkey").alias("request_url"),
                                                  F.lit(10).alias("priority"))
    com = fx.table(spark, sf, "orders").select(U.comment_request("o_orderkey").alias("request_url"),
                                               F.lit(0).alias("priority"))
    return od.order_requests(prof.unionByName(com)).select("request_url", "priority", "queue_pos")


@query("missing_pages", S.with_(S.POSTS, S.PROFILES, f"""
has_lines AS (SELECT DISTINCT l_orderkey FROM lineitem),
lastpost AS (SELECT arg_max(oid, pos) AS oid FROM posts WHERE {S.GOOD_POST} GROUP BY user_id, page_no),
miss AS (
  SELECT {S.PROFILE} || c_custkey || '&containerid=107603' || c_custkey AS request_url, 'status_list' AS kind,
         10 AS priority FROM prof
  WHERE c_acctbal >= 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)
  UNION ALL
  SELECT {S.COMMENT} || oid || '&mid=' || oid, 'hot_comments', 0 FROM lastpost
  WHERE oid NOT IN (SELECT l_orderkey FROM has_lines))
SELECT request_url, kind, CAST(max(priority) AS INTEGER) AS priority, count(*) AS n_asks FROM miss GROUP BY 1, 2"""))
def q_missing_pages(spark, sf):
    """Requests the landed pages imply whose URL is not landed."""
    return rq.missing_pages(_landed(spark, sf))


# The store keys of the seen sets (seen_weibo_chaohua_id, seen_weibo_movie_id_for_topic).
@query("exclude_seen", S.with_(S.DOCS, f"""
req AS (
  SELECT DISTINCT {S.FEED} || '100808' || source AS request_url, 'seen_weibo_chaohua_id' AS store_key,
         '100808' || source AS index_value, true AS dr FROM documents
  UNION ALL SELECT DISTINCT {S.CONTAINER} || '100120' || regexp_extract(p_brand, '(\\d+)', 1),
         'seen_weibo_movie_id_for_topic', '100120' || regexp_extract(p_brand, '(\\d+)', 1), false FROM part),
seen AS (SELECT DISTINCT 'seen_weibo_chaohua_id' AS store_key, '100808' || source AS index_value
         FROM documents WHERE n_chars >= 20000)
SELECT request_url, store_key, index_value FROM req r
WHERE NOT r.dr OR NOT EXISTS (SELECT 1 FROM seen s WHERE s.store_key = r.store_key AND s.index_value = r.index_value)"""))
def q_exclude_seen(spark, sf):
    """Requests marked for duplicate removal are dropped when already seen."""
    docs = fx.table(spark, sf, "documents")
    feed = fx.feed_of(F.col("source"))
    feeds = docs.select(U.supertopic_request(feed).alias("request_url"),
                        F.lit("seen_weibo_chaohua_id").alias("store_key"), feed.alias("index_value"),
                        F.lit(True).alias("duplicate_removal")).distinct()
    film = fx.film_of(F.col("p_brand"))
    films = fx.table(spark, sf, "part").select(U.topic_name_request(film).alias("request_url"),
                                               F.lit("seen_weibo_movie_id_for_topic").alias("store_key"),
                                               film.alias("index_value"), F.lit(False).alias("duplicate_removal")).distinct()
    seen = docs.where(F.col("n_chars") >= 20000).select(F.lit("seen_weibo_chaohua_id").alias("store_key"),
                                                        feed.alias("index_value"))
    return ln.exclude_seen(feeds.unionByName(films), seen).select("request_url", "store_key", "index_value")


@query("attach_parent", S.with_(S.COMMENTS, """
SELECT DISTINCT 'hot_comments:' || l_orderkey || ':' || page_no AS page_key,
       CAST(user_id AS VARCHAR) AS parent_user_id, CAST(l_orderkey AS VARCHAR) AS parent_status_id
FROM citems"""))
def q_attach_parent(spark, sf):
    """Comment pages landed without context get their post and author from the request table."""
    pages = comment_pages(spark, sf).drop("parent_user_id", "parent_status_id") \
        .withColumn("parent_user_id", F.lit(None).cast("string")) \
        .withColumn("parent_status_id", F.lit(None).cast("string"))
    o = fx.table(spark, sf, "orders")
    requests = o.select(U.comment_request("o_orderkey").alias("request_url"),
                        F.col("o_custkey").cast("string").alias("parent_user_id"),
                        F.col("o_orderkey").cast("string").alias("parent_status_id"))
    return ln.attach_parent(pages, requests, context=("parent_user_id", "parent_status_id")) \
        .select("page_key", "parent_user_id", "parent_status_id")
