"""Queries over profile, comment, super-topic and topic pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.functions.json import safe_path
from pagelake.functions.text import strip_query
from pagelake.functions.time import parse_created_at, site_time_text
from pagelake.operators import aggregates as ag
from pagelake.operators import chains
from pagelake.operators import extract as ex
from pagelake.operators import filters as fl
from pagelake.operators import links as ln
from pagelake.plans import fixtures as fx
from pagelake.plans import sql as S
from pagelake.plans.registry import query


def profile_pages(spark: SparkSession, sf: str) -> DataFrame:
    return fx.landed(spark, sf, ["profile"])


def comment_pages(spark: SparkSession, sf: str) -> DataFrame:
    return fx.landed(spark, sf, ["hot_comments"])


def feed_pages(spark: SparkSession, sf: str) -> DataFrame:
    return fx.landed(spark, sf, ["supertopic"])


def topic_pages(spark: SparkSession, sf: str) -> DataFrame:
    return fx.landed(spark, sf, ["topic_name", "topic_search"])


PROFILE_OUT = ["page_key", "user_id", "name", "follow_count", "followers_count", "description",
               "statuses_count", "verified", "verified_reason"]


# --------------------------------------------------------------------------- profiles

@query("extract_profiles", S.with_(S.PROFILES, f"""
SELECT page_key, {S.PROFILE_COLS} FROM prof WHERE c_acctbal >= 0"""))
def q_extract_profiles(spark, sf):
    """``data.userInfo`` -> profiles (pages missing a field left out)."""
    return ex.extract_profiles(profile_pages(spark, sf)).select(*PROFILE_OUT)


@query("verified_reason", S.with_(S.PROFILES, """
SELECT page_key, c_mktsegment IN ('BUILDING', 'AUTOMOBILE') AS verified,
  CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN c_mktsegment || ' expert' ELSE '' END AS verified_reason
FROM prof"""))
def q_verified_reason(spark, sf):
    """The reason only for verified accounts, else ''."""
    p = profile_pages(spark, sf)
    v = F.get_json_object("body", "$.data.userInfo.verified") == "true"
    return p.select("page_key", v.alias("verified"),
                    ex.verified_reason(v, F.get_json_object("body", "$.data.userInfo.verified_reason"))
                    .alias("verified_reason"))


@query("extract_container_id", S.with_(S.PROFILES, """
SELECT page_key, '107603' || c_custkey AS container_id FROM prof"""))
def q_extract_container_id(spark, sf):
    """Id of the second tab (the post list) of each profile page."""
    return profile_pages(spark, sf).select("page_key", ex.extract_container_id("body").alias("container_id"))


@query("dedupe_latest", S.with_(S.PROFILES, f"""
SELECT page_key, {S.PROFILE_COLS} FROM prof WHERE c_acctbal >= 0 AND page_key LIKE '%:1'"""))
def q_dedupe_latest(spark, sf):
    """One profile per account: the latest landed snapshot."""
    prof = ex.extract_profiles(profile_pages(spark, sf))
    return ln.dedupe_latest(prof, ["user_id"]).select(*PROFILE_OUT)


# --------------------------------------------------------------------------- comments

def comment_sql(where: str) -> str:
    return S.with_(S.COMMENTS, f"""
SELECT {S.COMMENT_COLS}, {S.COMMENT_KEY} AS page_key, page_no, pos FROM citems WHERE {where}""")


COMMENT_OUT = ex.COMMENT_OUT + ["page_key", "page_no", "pos"]


@query("extract_comments", comment_sql("good AND NOT (page_no > 0 AND no_cursor)"))
def q_extract_comments(spark, sf):
    """``data.data[*]`` -> comments (follow-up pages need a cursor)."""
    return ex.extract_comments(comment_pages(spark, sf)).select(*COMMENT_OUT)


@query("drop_terminal_page", comment_sql(
    "good AND NOT (page_no > 0 AND no_cursor) AND NOT (page_no > 0 AND last_page AND NOT no_cursor)"))
def q_drop_terminal_page(spark, sf):
    """A follow-up page whose ``max_id`` is 0 is dropped with its comments."""
    return ex.extract_comments(comment_pages(spark, sf), terminal_page="drop").select(*COMMENT_OUT)


@query("require_cursor", comment_sql("good AND NOT no_cursor"))
def q_require_cursor(spark, sf):
    """C8 ``'all'``: any comment page without ``max_id``/``max_id_type`` emits nothing."""
    return ex.extract_comments(comment_pages(spark, sf), require_cursor="all").select(*COMMENT_OUT)


@query("skip_bad_comments", comment_sql("good"))
def q_skip_bad_comments(spark, sf):
    """Comments missing a field (or with ``user: null``) are skipped, the rest go on."""
    items = ex.comment_items(comment_pages(spark, sf))
    return fl.skip_bad_comments(items).select(*COMMENT_OUT)


@query("union_comment_pages", S.with_(S.COMMENTS, f"""
SELECT CAST(l_orderkey AS VARCHAR) AS father_status_id, {S.COMMENT_KEY} AS page_key, pos, page_no = 0 AS is_first
FROM citems WHERE good AND NOT (page_no > 0 AND no_cursor)"""))
def q_union_comment_pages(spark, sf):
    """First pages and follow-up pages as one comments table."""
    pages = comment_pages(spark, sf)
    first = ex.extract_comments(pages.where(F.col("page_no") == 0)).withColumn("is_first", F.lit(True))
    follow = ex.extract_comments(pages.where(F.col("page_no") > 0)).withColumn("is_first", F.lit(False))
    return ln.union_comment_pages(first, follow).select("father_status_id", "page_key", "pos", "is_first")


@query("distinct_commenters", S.with_(S.COMMENTS, """
SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS user_id FROM citems WHERE good AND NOT (page_no > 0 AND no_cursor)"""))
def q_distinct_commenters(spark, sf):
    return ag.distinct_commenters(ex.extract_comments(comment_pages(spark, sf)))


@query("seed_counts", S.with_(S.COMMENTS, """
SELECT count(*) AS n_rows, count(l_suppkey) AS n_ids, count(DISTINCT CAST(l_suppkey AS BIGINT)) AS n_distinct
FROM citems WHERE good AND NOT (page_no > 0 AND no_cursor)"""))
def q_seed_counts(spark, sf):
    """List size and set size of the commenter column."""
    return ag.seed_counts(ex.extract_comments(comment_pages(spark, sf)), "comment_people_id")


@query("comments_with_status", S.with_(S.COMMENTS, S.POSTS, f"""
SELECT 'hot_comments:' || c.l_orderkey || ':' || c.page_no AS page_key, c.pos,
       CAST(l_orderkey AS VARCHAR) AS father_status_id,
       CAST(l_suppkey AS BIGINT) AS comment_people_id, CAST(p.user_id AS BIGINT) AS status_user_id,
       p.o_orderdate AS status_ts
FROM citems c JOIN posts p ON p.oid = c.l_orderkey
WHERE c.good AND NOT (c.page_no > 0 AND c.no_cursor) AND NOT p.bad_date AND NOT p.no_text"""))
def q_comments_with_status(spark, sf):
    """Each comment joined to the post it is on."""
    from pagelake.plans.q_feed import status_pages
    comments = ex.extract_comments(comment_pages(spark, sf))
    statuses = ex.extract_statuses(status_pages(spark, sf))
    out = ln.comments_with_status(comments, statuses)
    return out.select("page_key", "pos", "father_status_id", "comment_people_id", "status_user_id", "status_ts")


@query("comment_people", S.with_(S.COMMENTS, S.PROFILES, """
latest AS (SELECT * FROM prof WHERE c_acctbal >= 0 AND page_key LIKE '%:1')
SELECT 'hot_comments:' || c.l_orderkey || ':' || c.page_no AS page_key, c.pos,
       CAST(c.l_suppkey AS BIGINT) AS comment_people_id, p.c_name AS name, p.followers AS followers_count,
       p.c_mktsegment IN ('BUILDING', 'AUTOMOBILE') AS verified,
       CASE WHEN p.c_custkey IS NULL THEN NULL WHEN p.c_mktsegment IN ('BUILDING', 'AUTOMOBILE')
            THEN p.c_mktsegment || ' expert' ELSE '' END AS verified_reason
FROM citems c LEFT JOIN latest p ON p.c_custkey = c.l_suppkey
WHERE c.good AND NOT (c.page_no > 0 AND c.no_cursor)"""))
def q_comment_people(spark, sf):
    """Wide row: comment plus the commenter's latest profile (left join)."""
    comments = ex.extract_comments(comment_pages(spark, sf))
    prof = ex.extract_profiles(profile_pages(spark, sf))
    out = ln.comment_people(comments, prof)
    return out.select("page_key", "pos", "comment_people_id", "name", "followers_count", "verified",
                      "verified_reason")


@query("commenter_statuses", S.with_(S.COMMENTS, S.POSTS, f"""
SELECT {S.STATUS_COLS} FROM posts WHERE {S.GOOD_POST}
  AND user_id IN (SELECT l_suppkey FROM citems WHERE good AND NOT (page_no > 0 AND no_cursor))"""))
def q_commenter_statuses(spark, sf):
    """Posts of accounts that commented (semi join)."""
    from pagelake.plans.q_feed import status_pages
    comments = ex.extract_comments(comment_pages(spark, sf))
    statuses = ex.extract_statuses(status_pages(spark, sf), lineage=False)
    return ln.commenter_statuses(statuses, comments)


@query("parse_created_at", f"""
SELECT l_orderkey, l_linenumber, l_shipdate AS created_ts, CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(month(l_shipdate) AS INTEGER) AS month
FROM lineitem""")
def q_parse_created_at(spark, sf):
    """Site time text -> instant, written year and month (round trip of ``l_shipdate``)."""
    li = fx.table(spark, sf, "lineitem")
    p = parse_created_at(site_time_text("l_shipdate"))
    return li.select("l_orderkey", "l_linenumber", p["ts"].alias("created_ts"), p["year"].alias("year"),
                     p["month"].alias("month"))


# --------------------------------------------------------------------------- super-topic

@query("extract_supertopic_posts", S.with_(S.DOCS, f"""
SELECT '100808' || source AS chaohua_id, CAST(doc_id AS VARCHAR) AS cid, source || ' fans' AS nick,
  CAST(n_chars AS VARCHAR) AS comments_count,
  {S.site_text("TIMESTAMP '2023-06-01 00:00:00' + doc_id * INTERVAL 1 MINUTE")} AS created_at,
  lang AS source, text, CAST(n_chars AS VARCHAR) AS user_id, 'writes in ' || lang AS description,
  source || '_' || lang AS screen_name, CAST(n_chars // 10 AS VARCHAR) AS followers_count,
  CASE WHEN lang <> 'en' THEN 'voice of ' || source ELSE '' END AS verified_reason
FROM docs"""))
def q_extract_supertopic_posts(spark, sf):
    """Feed posts (outer card 11, inner 9) with author columns; whole texts."""
    return ex.extract_supertopic_posts(feed_pages(spark, sf))


@query("drop_not_ok", S.with_(S.DOCS, S.PARTS, """
SELECT 'supertopic' AS kind, count(*) AS n_pages FROM dpages
UNION ALL SELECT 'topic_search', count(*) FROM tpages
UNION ALL SELECT 'topic_name', count(DISTINCT p_brand) FROM part"""))
def q_drop_not_ok(spark, sf):
    """Pages left after dropping ``ok: 0`` (a missing ``ok`` goes on)."""
    pages = feed_pages(spark, sf).unionByName(topic_pages(spark, sf))
    return fl.drop_not_ok(pages).groupBy("kind").agg(F.count(F.lit(1)).alias("n_pages"))


@query("explode_card_groups", S.with_(S.DOCS, """
SELECT 'supertopic:100808' || source || ':' || CAST(r // 5 AS INTEGER) AS page_key, CAST(1 AS BIGINT) AS pos,
       CAST(r - (r // 5) * 5 AS BIGINT) AS gpos, '11' AS card_type FROM docs
UNION ALL
SELECT 'supertopic:100808' || source || ':' || page_no, CAST(1 AS BIGINT), CAST(n AS BIGINT), '11' FROM dpages"""))
def q_explode_card_groups(spark, sf):
    """Two levels: cards, then each card's group items (absent group: no rows)."""
    g = ex.explode_card_groups(feed_pages(spark, sf))
    return g.select("page_key", "pos", "gpos", "card_type")


@query("keep_card_type", S.with_(S.DOCS, """
SELECT 'supertopic:100808' || source || ':' || CAST(r // 5 AS INTEGER) AS page_key,
       CAST(r - (r // 5) * 5 AS BIGINT) AS gpos, CAST(doc_id AS VARCHAR) AS cid FROM docs"""))
def q_keep_card_type(spark, sf):
    """Inner cards of type ``"9"`` under outer cards ``"11"``, type-strict."""
    g = ex.explode_card_groups(feed_pages(spark, sf))
    g = g.where(F.col("card_type") == "11").withColumn("_i", ex.as_map("item"))
    kept = fl.keep_card_type(g, ex.get(F.col("_i"), "card_type"), "item", ["9"], strict_type=True)
    return kept.select("page_key", "gpos", F.get_json_object("item", "$.mblog.id").alias("cid"))


@query("safe_path", S.with_(S.DOCS, """
SELECT 'supertopic:100808' || source || ':' || page_no AS page_key, CAST(page_no + 1 AS VARCHAR) AS since_id,
       '' AS absent FROM dpages
UNION ALL SELECT 'supertopic:100808' || source || ':' || page_no, '', '' FROM dlast"""))
def q_safe_path(spark, sf):
    """Nested lookup with '' on any miss (absent key or non-object parent)."""
    p = feed_pages(spark, sf)
    return p.select("page_key", safe_path("body", ["data", "pageInfo", "since_id"]).alias("since_id"),
                    safe_path("body", ["data", "nick", "x"]).alias("absent"))


# --------------------------------------------------------------------------- topics

@query("extract_topics", S.with_(S.PARTS, f"SELECT {S.TOPIC_COLS} FROM parts"))
def q_extract_topics(spark, sf):
    """Topic search results (inner card 8) with film id and title."""
    return ex.extract_topics(topic_pages(spark, sf))


@query("extract_topic_title", "SELECT DISTINCT '100120' || regexp_extract(p_brand, '(\\d+)', 1) AS film_id, "
                              "p_brand AS title FROM part")
def q_extract_topic_title(spark, sf):
    """Film title (``data.pageInfo.nick``) of each film page."""
    return ex.extract_topic_title(topic_pages(spark, sf))


@query("topics_for_films", S.with_(S.PARTS, """
SELECT film_id AS weibo_movie_id, p_brand AS film_title, p_name AS title_sub, 'topic_' || p_partkey AS item_id
FROM parts"""))
def q_topics_for_films(spark, sf):
    """Film seeds -> title page -> topic rows."""
    from pagelake.sources.seeds import read_seed_set
    films = read_seed_set(spark, fx.table(spark, sf, "part").select(fx.film_of(F.col("p_brand")).alias("id")))
    pages = topic_pages(spark, sf)
    out = ln.topics_for_films(films, ex.extract_topic_title(pages), ex.extract_topics(pages))
    return out.select("weibo_movie_id", "film_title", "title_sub", "item_id")


# --------------------------------------------------------------------------- order by cursors

# A page without a cursor names no successor, so the next page starts a piece of its own.
CUT_OFF = "no_cursor AND page_no > 0"
OWN_CURSOR = "CAST(l_orderkey * 10 + page_no AS VARCHAR)"


@query("comment_chain_order", S.with_(S.COMMENTS, f"""
SELECT DISTINCT {S.COMMENT_KEY} AS page_key, page_no, CAST(CASE WHEN {CUT_OFF} THEN 0 ELSE page_no END AS BIGINT) AS chain_pos,
       CASE WHEN {CUT_OFF} THEN {OWN_CURSOR} ELSE '' END AS chain_head,
       CASE WHEN {CUT_OFF} THEN 'broken' ELSE 'whole' END AS chain_status
FROM citems"""))
def q_comment_chain_order(spark, sf):
    """Place of every comment page in its post's chain of cursors, page numbers unseen."""
    pages = comment_pages(spark, sf).withColumn("page_no", F.lit(None).cast("int"))
    return chains.chain_order(pages, "hot_comments").select("page_key", "page_no", "chain_pos", "chain_head", "chain_status")


@query("broken_chains", S.with_(S.COMMENTS, f"""
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS chain_key, 'broken' AS chain_status, {OWN_CURSOR} AS chain_head,
       CAST(1 AS BIGINT) AS n_pages
FROM citems WHERE {CUT_OFF}"""))
def q_broken_chains(spark, sf):
    """Comment pages that no landed page leads to."""
    return chains.broken_chains(comment_pages(spark, sf), "hot_comments")


# --------------------------------------------------------------------------- URLs of the pages table

@query("strip_query", "SELECT page_id, split_part(url, '?', 1) AS origin_url FROM pages")
def q_strip_query(spark, sf):
    """URL up to the first ``?``."""
    return fx.table(spark, sf, "pages").select("page_id", strip_query("url").alias("origin_url"))


@query("on_allowed_domain", """
SELECT page_id, url FROM (
  SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]+)', 1)) AS host FROM pages)
WHERE host = 'example.com' OR host LIKE '%.example.com'""")
def q_on_allowed_domain(spark, sf):
    """C11: keep URLs whose host is, or is under, an allowed domain."""
    return fl.on_allowed_domain(fx.table(spark, sf, "pages").select("page_id", "url"), "url", ["example.com"])
