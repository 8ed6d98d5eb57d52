"""Shared DuckDB SQL fragments for the oracle texts.

They restate, in SQL over the base tables, how the fixture pages lay the
tables out (see ``fixtures``), so an oracle can say what each operator must
return without running any of the Spark code.
"""

SITE_FMT = "'%a %b %d %H:%M:%S +0800 %Y'"


def site_text(ts: str) -> str:
    return f"strftime({ts} + INTERVAL 8 HOUR, {SITE_FMT})"


# The site's addresses, as in functions/urls.py (restated, since oracles share no code).
PROFILE = "'https://m.weibo.cn/api/container/getIndex?type=uid&value='"
COMMENT = "'https://m.weibo.cn/comments/hotflow?id='"
FEED = "'https://m.weibo.cn/api/container/getIndex?jumpfrom=weibocom&containerid='"
CONTAINER = "'https://m.weibo.cn/api/container/getIndex?containerid='"

# Feed of each account: newest first by post id, 10 posts a page, slot 0 is a promo card.
POSTS = """
feed AS (
  SELECT o_custkey AS user_id, o_orderkey AS oid, o_orderdate, o_totalprice, o_orderpriority, o_orderstatus,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) - 1 AS rn,
         count(*) OVER (PARTITION BY o_custkey) AS n_posts
  FROM orders),
posts AS (
  SELECT *, CAST(rn // 10 AS INTEGER) AS page_no, CAST(rn - (rn // 10) * 10 + 1 AS BIGINT) AS pos,
         (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') AS bad_date,
         (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F') AS no_text,
         year(o_orderdate) AS yr, month(o_orderdate) AS mo
  FROM feed)"""

STATUS_COLS = f"""
  CAST(user_id AS BIGINT) AS user_id,
  {site_text('o_orderdate')} AS edit_at,
  o_orderdate AS created_ts,
  o_orderpriority || ' / ' || o_orderstatus AS text,
  CAST(floor(o_totalprice / 1000) AS BIGINT) AS reposts_count,
  CAST(floor(o_totalprice) AS BIGINT) AS comments_count,
  CAST(round(o_totalprice * 100) AS BIGINT) - CAST(floor(o_totalprice) AS BIGINT) * 100 AS attitudes_count,
  CAST(oid AS VARCHAR) AS status_id,
  'https://m.weibo.cn/status/' || oid AS origin_url"""

GOOD_POST = "NOT bad_date AND NOT no_text"

# Comments: two a page per order, by line number.
COMMENTS = """
crow AS (
  SELECT l.*, o.o_custkey AS user_id, o.o_orderpriority, o.o_orderstatus,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                                     l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) - 1 AS r,
         count(*) OVER (PARTITION BY l_orderkey) AS n_lines
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
citems AS (
  SELECT *, CAST(r // 2 AS INTEGER) AS page_no, CAST(r - (r // 2) * 2 AS BIGINT) AS pos,
         (o_orderpriority = '2-HIGH' AND o_orderstatus = 'F') AS no_cursor,
         (r // 2) = (n_lines - 1) // 2 AS last_page,
         (l_discount <> 0 AND l_tax <> 0) AS good
  FROM crow)"""

COMMENT_COLS = f"""
  CAST(user_id AS VARCHAR) AS father_user_id,
  CAST(l_orderkey AS VARCHAR) AS father_status_id,
  {site_text('l_shipdate')} AS comment_time,
  l_shipdate AS comment_ts,
  'line ' || l_linenumber || ' of ' || l_orderkey AS text,
  CAST(l_suppkey AS BIGINT) AS comment_people_id,
  'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS comment_people_name,
  CAST(trunc(l_quantity) AS BIGINT) AS comment_likes,
  CAST(l_linenumber AS BIGINT) AS total_number"""

COMMENT_KEY = "'hot_comments:' || l_orderkey || ':' || page_no"

PROFILES = """
prof AS (
  SELECT c.*, 'profile:' || c_custkey || ':1' AS page_key, CAST(floor(c_acctbal) AS BIGINT) AS followers
  FROM customer c
  UNION ALL
  SELECT c.*, 'profile:' || c_custkey || ':0' AS page_key, CAST(0 AS BIGINT) AS followers
  FROM customer c WHERE c_mktsegment = 'MACHINERY')"""

PROFILE_COLS = """
  CAST(c_custkey AS BIGINT) AS user_id, c_name AS name, CAST(c_nationkey AS BIGINT) AS follow_count,
  followers AS followers_count, c_mktsegment || ' buyer' AS description,
  CAST(c_nationkey + 1 AS BIGINT) AS statuses_count,
  c_mktsegment IN ('BUILDING', 'AUTOMOBILE') AS verified,
  CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN c_mktsegment || ' expert' ELSE '' END AS verified_reason"""

# Super-topic feeds: 5 documents a page per source, then one ok:0 page.
DOCS = """
docs AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS r FROM documents),
dpages AS (
  SELECT source, CAST(r // 5 AS INTEGER) AS page_no, count(*) AS n FROM docs GROUP BY 1, 2),
dlast AS (SELECT source, CAST(max(page_no) + 1 AS INTEGER) AS page_no FROM dpages GROUP BY 1)"""

# Topic search: 8 parts a page per brand, pages from 1, then one ok:0 page.
PARTS = """
parts AS (
  SELECT *, '100120' || regexp_extract(p_brand, '(\\d+)', 1) AS film_id,
         CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS brand_no,
         row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS r FROM part),
tpages AS (
  SELECT p_brand, film_id, brand_no, CAST(r // 8 + 1 AS INTEGER) AS page_no, count(*) AS n FROM parts GROUP BY 1, 2, 3, 4),
tlast AS (SELECT p_brand, film_id, CAST(max(page_no) + 1 AS INTEGER) AS page_no FROM tpages GROUP BY 1, 2)"""

TOPIC_COLS = """
  film_id AS weibo_movie_id, p_brand AS weibo_movie_name, p_name AS title_sub, p_type AS desc1,
  'size ' || p_size AS desc2, 'https://img.example.com/p/' || p_partkey || '.jpg' AS pic,
  'topic_' || p_partkey AS item_id,
  CASE WHEN p_type <> 'ECONOMY' THEN 'size|' || p_size ELSE '' END AS analysis_extra"""

# Fetch log: one fetch per event.
FETCHES = f"""
fetch0 AS (
  SELECT event_id, ts, user_id, 'fetch:' || event_id AS page_key,
         {PROFILE} || user_id || '&containerid=107603' || user_id || '&since_id=' || json_extract_string(props, '$.k') AS request_url,
         CAST(CASE event_type WHEN 'purchase' THEN 404 WHEN 'signup' THEN 418 WHEN 'error' THEN 503 ELSE 200 END AS INTEGER) AS http_status
  FROM events),
fetches AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY request_url ORDER BY ts, event_id) AS INTEGER) AS attempt FROM fetch0)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)
