"""Registered end-to-end flows (E1-E3) and the cast helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelake.functions.text import counter, id_text
from pagelake.operators import extract as ex
from pagelake.operators import ordinal as od
from pagelake.plans import fixtures as fx
from pagelake.plans import flows, q_pages  # noqa: F401 - its oracle texts are used here
from pagelake.plans import sql as S
from pagelake.plans.q_feed import CUTOFF_YEAR, WINDOW_MONTH, WINDOW_YEAR, status_pages
from pagelake.plans.q_seeds import LIST_SQL, RANK_HI, RANK_LO, done_list, id_list
from pagelake.plans.registry import ORACLE, query
from pagelake.sources.seeds import read_seed_set


@query("flow_actor_posts", S.with_(S.POSTS, LIST_SQL, f"""
ranked AS (SELECT id, row_number() OVER (ORDER BY n_posts, ordinal) - 1 AS rank FROM lst),
chosen AS (SELECT CAST(id AS BIGINT) AS user_id FROM ranked WHERE rank >= {RANK_LO} AND rank < {RANK_HI}),
stops AS (SELECT user_id, min(rn) AS first_stop FROM posts WHERE NOT bad_date AND yr < {CUTOFF_YEAR} GROUP BY 1)
SELECT {S.STATUS_COLS} FROM posts LEFT JOIN stops USING (user_id)
WHERE (first_stop IS NULL OR rn < first_stop) AND {S.GOOD_POST} AND user_id IN (SELECT user_id FROM chosen)"""))
def q_flow_actor_posts(spark, sf):
    """Posts, until the cutoff year, of the accounts ranked 1200-1399 by post count."""
    pages = fx.landed(spark, sf, ["status_list", "profile", "hot_comments"])
    return flows.actor_feeds(pages, id_list(spark, sf), RANK_LO, RANK_HI, CUTOFF_YEAR)["statuses"]


@query("flow_actor_comments", S.with_(S.POSTS, S.COMMENTS, LIST_SQL, f"""
ranked AS (SELECT id, row_number() OVER (ORDER BY n_posts, ordinal) - 1 AS rank FROM lst),
chosen AS (SELECT CAST(id AS BIGINT) AS user_id FROM ranked WHERE rank >= {RANK_LO} AND rank < {RANK_HI}),
stops AS (SELECT user_id, min(rn) AS first_stop FROM posts WHERE NOT bad_date AND yr < {CUTOFF_YEAR} GROUP BY 1),
kept AS (SELECT * FROM posts LEFT JOIN stops USING (user_id)
         WHERE (first_stop IS NULL OR rn < first_stop) AND {S.GOOD_POST} AND user_id IN (SELECT user_id FROM chosen)),
last AS (SELECT arg_max(oid, pos) AS oid FROM kept GROUP BY user_id, page_no)
SELECT {S.COMMENT_COLS} FROM citems
WHERE good AND NOT (page_no > 0 AND no_cursor) AND l_orderkey IN (SELECT oid FROM last)"""))
def q_flow_actor_comments(spark, sf):
    """Hot comments on the last kept post of each page of the chosen accounts."""
    pages = fx.landed(spark, sf, ["status_list", "profile", "hot_comments"])
    out = flows.actor_feeds(pages, id_list(spark, sf), RANK_LO, RANK_HI, CUTOFF_YEAR)["comments"]
    return out.select(*ex.COMMENT_OUT)


@query("flow_commenter_posts", S.with_(S.POSTS, S.COMMENTS, f"""
who AS (SELECT DISTINCT l_suppkey AS user_id FROM citems WHERE good AND NOT (page_no > 0 AND no_cursor)
        AND CAST(l_suppkey AS VARCHAR) NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)),
stops AS (SELECT user_id, min(rn) AS first_stop FROM posts
          WHERE NOT bad_date AND (yr < {WINDOW_YEAR} OR mo < {WINDOW_MONTH}) GROUP BY 1)
SELECT {S.STATUS_COLS} FROM posts LEFT JOIN stops USING (user_id)
WHERE (first_stop IS NULL OR rn < first_stop) AND {S.GOOD_POST} AND mo = {WINDOW_MONTH}
  AND user_id IN (SELECT user_id FROM who)"""))
def q_flow_commenter_posts(spark, sf):
    """Status seeds -> comments -> new commenters (minus done) -> their month-window posts."""
    pages = fx.landed(spark, sf, ["status_list", "hot_comments"])
    o = fx.table(spark, sf, "orders")
    seeds = o.select(F.col("o_orderkey").cast("string").alias("statues_id"),
                     F.col("o_custkey").cast("string").alias("user_id"))
    return flows.commenter_feeds(pages, seeds, done_list(spark, sf), WINDOW_YEAR, WINDOW_MONTH)["statuses"]


@query("flow_actor_all_posts", S.with_(S.POSTS, LIST_SQL, f"""
ranked AS (SELECT id, row_number() OVER (ORDER BY n_posts, ordinal) - 1 AS rank FROM lst),
chosen AS (SELECT CAST(id AS BIGINT) AS user_id FROM ranked WHERE rank >= {RANK_LO} AND rank < {RANK_HI})
SELECT {S.STATUS_COLS} FROM posts WHERE {S.GOOD_POST} AND user_id IN (SELECT user_id FROM chosen)"""))
def q_flow_actor_all_posts(spark, sf):
    """E1 without a cutoff: every good post of the chosen accounts."""
    pages = fx.landed(spark, sf, ["status_list", "profile", "hot_comments"])
    return flows.actor_feeds(pages, id_list(spark, sf), RANK_LO, RANK_HI)["statuses"].select(*ex.STATUS_OUT)


RESUME_AT = 3


@query("flow_commenter_shares", S.with_(S.POSTS, S.COMMENTS, f"""
who AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS id FROM citems WHERE good AND NOT (page_no > 0 AND no_cursor)
        AND CAST(l_suppkey AS VARCHAR) NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)),
placed AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS i, count(*) OVER () AS n FROM who),
cut AS (SELECT *, ((i + 1) * 32 + n - 1) // n - 1 AS k FROM placed),
todo AS (SELECT CAST(id AS BIGINT) AS user_id FROM cut
         WHERE (k < 16 OR i - n * k // 32 >= CAST(floor((n * (k + 1) // 32 - n * k // 32) * CAST(0.15 AS DOUBLE)) AS BIGINT))
           AND CAST(id AS BIGINT) >= {RESUME_AT}),
stops AS (SELECT user_id, min(rn) AS first_stop FROM posts WHERE NOT bad_date AND yr < {CUTOFF_YEAR} GROUP BY 1)
SELECT {S.STATUS_COLS} FROM posts LEFT JOIN stops USING (user_id)
WHERE (first_stop IS NULL OR rn < first_stop) AND {S.GOOD_POST} AND user_id IN (SELECT user_id FROM todo)"""))
def q_flow_commenter_shares(spark, sf):
    """E2 with 32 shares, the 15 % skip, done ids and a resume point: posts until the cutoff year."""
    pages = fx.landed(spark, sf, ["status_list", "hot_comments"])
    seeds = fx.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("statues_id"),
                                                 F.col("o_custkey").cast("string").alias("user_id"))
    out = flows.commenter_feeds(pages, seeds, done_list(spark, sf), CUTOFF_YEAR, shares=32, resume_at=RESUME_AT)
    return out["statuses"]


@query("running_max_id", S.with_(S.POSTS, f"""
acc AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM posts WHERE {S.GOOD_POST}),
placed AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS i, count(*) OVER () AS n FROM acc),
sh AS (SELECT CAST(id AS BIGINT) AS user_id, CAST(((i + 1) * 32 + n - 1) // n - 1 AS INTEGER) AS share FROM placed),
g AS (SELECT share, page_no, pos, p.user_id, oid FROM posts p JOIN sh USING (user_id) WHERE {S.GOOD_POST})
SELECT share, CAST(oid AS VARCHAR) AS status_id, max(CAST(user_id AS BIGINT)) OVER (
  PARTITION BY share ORDER BY page_no, pos, CAST(oid AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS max_id
FROM g"""))
def q_running_max_id(spark, sf):
    """The progress mark while a share's posts come in: highest account id so far, per share of 32."""
    posts = ex.extract_statuses(status_pages(spark, sf)).select("user_id", "page_no", "pos", "status_id")
    ids = posts.select(F.col("user_id").cast("string").alias("id")).distinct()
    shares = od.fraction_slice(od.add_ordinal(ids, ["id"], length="_len"), 32)
    slices = posts.join(shares.select(F.col("id").cast("bigint").alias("user_id"), "share"), "user_id")
    out = od.keyed_running_max(slices, ["share"], ["page_no", "pos", "status_id"], F.col("user_id"), "max_id")
    return out.select("share", "status_id", "max_id")


@query("flow_supertopic_posts", ORACLE["extract_supertopic_posts"])
def q_flow_supertopic_posts(spark, sf):
    """Feed seeds -> feed pages -> posts."""
    return flows.supertopic_feeds(fx.landed(spark, sf, ["supertopic"]), feed_seeds(spark, sf))["posts"]


@query("flow_supertopic_requests", S.with_(S.DOCS, f"""
SELECT {S.FEED} || '100808' || source || '&since_id=' || (page_no + 1) AS request_url, 'supertopic' AS kind
FROM dpages"""))
def q_flow_supertopic_requests(spark, sf):
    """Feed seeds -> feed pages -> the next pages they ask for."""
    out = flows.supertopic_feeds(fx.landed(spark, sf, ["supertopic"]), feed_seeds(spark, sf))
    return out["requests"].select("request_url", "kind")


def feed_seeds(spark, sf):
    """Every feed, as a seed set."""
    return read_seed_set(spark, fx.table(spark, sf, "documents").select(fx.feed_of(F.col("source")).alias("id")))


@query("flow_film_topics", S.with_(S.PARTS, """
SELECT film_id AS weibo_movie_id, p_brand AS film_title, count(*) AS n_topics FROM parts GROUP BY 1, 2"""))
def q_flow_film_topics(spark, sf):
    """Film seeds -> titles -> topic results, counted per film."""
    pages = fx.landed(spark, sf, ["topic_name", "topic_search"])
    films = read_seed_set(spark, fx.table(spark, sf, "part").select(fx.film_of(F.col("p_brand")).alias("id")))
    return flows.film_topics(pages, films)["per_film"]


@query("casts", S.with_(S.POSTS, """
SELECT 'status_list:' || user_id || ':' || page_no AS page_key, pos, CAST(user_id AS BIGINT) AS user_id,
       CAST(oid AS VARCHAR) AS status_id, CAST(floor(o_totalprice) AS BIGINT) AS comments_count,
       CAST(floor(o_totalprice / 1000) AS BIGINT) AS reposts_count
FROM posts"""))
def q_casts(spark, sf):
    """Ids as text, counters from text or numbers to BIGINT, request ids to BIGINT."""
    cards = ex.explode_cards(status_pages(spark, sf))
    m = ex.as_map(F.get_json_object("card", "$.mblog"))
    cards = cards.withColumn("_m", m).where(F.size(F.json_object_keys("card")) != 4
                                           ).where(F.array_contains(F.json_object_keys("card"), "mblog"))
    return cards.select("page_key", "pos", F.col("seed_key").try_cast("bigint").alias("user_id"),
                        id_text(ex.get(F.col("_m"), "id")).alias("status_id"),
                        counter(ex.get(F.col("_m"), "comments_count")).alias("comments_count"),
                        counter(ex.get(F.col("_m"), "reposts_count")).alias("reposts_count"))


@query("silver_statuses_until", S.with_(S.POSTS, f"""
stops AS (SELECT user_id, min(rn) AS first_stop FROM posts WHERE NOT bad_date AND yr < {CUTOFF_YEAR} GROUP BY 1)
SELECT {S.STATUS_COLS} FROM posts LEFT JOIN stops USING (user_id)
WHERE (first_stop IS NULL OR rn < first_stop) AND {S.GOOD_POST}"""))
def q_silver_statuses_until(spark, sf):
    """The flagship through a silver table: cards appended once, cutoff read from silver."""
    from pagelake.session import fresh_dir
    path = flows.land_status_silver(status_pages(spark, sf), fresh_dir(spark, "silver-cards"))
    return flows.statuses_until_silver(spark, path, CUTOFF_YEAR)


def card_store(spark, sf):
    """All feeds in a clustered store, landed in two loads (first pages, later pages)."""
    from pagelake.session import fresh_dir
    from pagelake.sources.card_store import CardStore

    store, pages = CardStore(spark, fresh_dir(spark, "card-store")), status_pages(spark, sf)
    store.load(pages.where(F.col("page_no") == 0), "first")
    store.load(pages.where(F.col("page_no") > 0), "later")
    return store


@query("card_store_until", ORACLE["silver_statuses_until"])
def q_card_store_until(spark, sf):
    """The flagship from the clustered store: stops from its summary, folders without kept posts not read."""
    return card_store(spark, sf).until_year(CUTOFF_YEAR).select(*ex.STATUS_OUT)


@query("card_store_month", ORACLE["month_window"])
def q_card_store_month(spark, sf):
    """The month window from the clustered store."""
    return card_store(spark, sf).month_window(WINDOW_YEAR, WINDOW_MONTH).select(*ex.STATUS_OUT)
