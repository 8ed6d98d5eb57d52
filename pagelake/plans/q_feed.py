"""Queries over account feeds (``status_list`` pages built from ``orders``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.operators import aggregates as ag
from pagelake.operators import chains
from pagelake.operators import extract as ex
from pagelake.operators import filters as fl
from pagelake.operators import links as ln
from pagelake.plans import fixtures as fx
from pagelake.plans import sql as S
from pagelake.plans.registry import query

# Parameters of the registered queries (the test tables span 1995-2001).
CUTOFF_YEAR = 1997
WINDOW_YEAR = 1998
WINDOW_MONTH = 4


def status_pages(spark: SparkSession, sf: str) -> DataFrame:
    return fx.landed(spark, sf, ["status_list"])


def statuses_until(spark: SparkSession, sf: str, min_year: int = CUTOFF_YEAR, strict: bool = False) -> DataFrame:
    """Each account's posts, newest first, until the first one written before
    ``min_year`` (the flagship query)."""
    return fl.year_cutoff_pages(status_pages(spark, sf), min_year, strict=strict).select(*ex.STATUS_OUT)


UNTIL_SQL = S.with_(S.POSTS, f"""
stops AS (SELECT user_id, min(rn) AS first_stop FROM posts WHERE NOT bad_date AND yr < {CUTOFF_YEAR} GROUP BY 1)
SELECT {S.STATUS_COLS} FROM posts LEFT JOIN stops USING (user_id)
WHERE (first_stop IS NULL OR rn < first_stop) AND {S.GOOD_POST}""")


@query("statuses_until", UNTIL_SQL)
def q_statuses_until(spark, sf):
    """C4 take_until: posts newest first until the first before the cutoff year."""
    return statuses_until(spark, sf)


@query("statuses_until_by_cursor", UNTIL_SQL)
def q_statuses_until_by_cursor(spark, sf):
    """C4 on pages without numbers: their order comes from the cursors alone."""
    pages = status_pages(spark, sf).withColumn("page_no", F.lit(None).cast("int"))
    return fl.year_cutoff_pages(chains.renumber(pages), CUTOFF_YEAR).select(*ex.STATUS_OUT)


@query("chain_order", S.with_(S.POSTS, """
SELECT DISTINCT 'status_list:' || user_id || ':' || page_no AS page_key, page_no, CAST(page_no AS BIGINT) AS chain_pos,
       '' AS chain_head, 'whole' AS chain_status FROM posts"""))
def q_chain_order(spark, sf):
    """Place of every post-list page in its account's chain of cursors."""
    pages = status_pages(spark, sf).withColumn("page_no", F.lit(None).cast("int"))
    return chains.chain_order(pages).select("page_key", "page_no", "chain_pos", "chain_head", "chain_status")


@query("take_until", UNTIL_SQL)
def q_take_until(spark, sf):
    """C4 as the general operator: any keys, order and stop rule, on classified cards."""
    cards = ex.status_cards(status_pages(spark, sf)).where(~F.col("is_promo"))
    kept = fl.take_until(cards, ["seed_key"], ["page_no", "pos"], F.col("year") < CUTOFF_YEAR)
    return kept.where(F.col("reject_reason").isNull()).select(*ex.STATUS_OUT)


@query("take_until_filter", S.with_(S.POSTS, f"""
SELECT {S.STATUS_COLS} FROM posts WHERE {S.GOOD_POST} AND yr >= {CUTOFF_YEAR}"""))
def q_take_until_filter(spark, sf):
    """C4 ``mode='filter'``: drop only the old posts."""
    cards = ex.status_cards(status_pages(spark, sf))
    return fl.year_cutoff(cards, CUTOFF_YEAR, mode="filter").select(*ex.STATUS_OUT)


@query("strict_page", S.with_(S.POSTS, f"""
pbad AS (SELECT user_id, page_no, min(pos) AS first_bad FROM posts
         WHERE bad_date OR (no_text AND yr >= {CUTOFF_YEAR}) GROUP BY 1, 2),
kept AS (SELECT p.* FROM posts p LEFT JOIN pbad b USING (user_id, page_no)
         WHERE b.first_bad IS NULL OR p.pos < b.first_bad),
stops AS (SELECT user_id, min(rn) AS first_stop FROM kept WHERE NOT bad_date AND yr < {CUTOFF_YEAR} GROUP BY 1)
SELECT {S.STATUS_COLS} FROM kept LEFT JOIN stops USING (user_id)
WHERE (first_stop IS NULL OR rn < first_stop) AND {S.GOOD_POST}"""))
def q_strict_page(spark, sf):
    """The first bad card ends its page (decided inside the page), then the year cutoff."""
    return fl.year_cutoff_pages(status_pages(spark, sf), CUTOFF_YEAR, strict=True).select(*ex.STATUS_OUT)


@query("month_window", S.with_(S.POSTS, f"""
stops AS (SELECT user_id, min(rn) AS first_stop FROM posts
          WHERE NOT bad_date AND (yr < {WINDOW_YEAR} OR mo < {WINDOW_MONTH}) GROUP BY 1)
SELECT {S.STATUS_COLS} FROM posts LEFT JOIN stops USING (user_id)
WHERE (first_stop IS NULL OR rn < first_stop) AND {S.GOOD_POST} AND mo = {WINDOW_MONTH}"""))
def q_month_window(spark, sf):
    """Emit the month, skip later months, stop at an earlier month or year."""
    return fl.month_window_pages(status_pages(spark, sf), WINDOW_YEAR, WINDOW_MONTH).select(*ex.STATUS_OUT)


@query("extract_statuses", S.with_(S.POSTS, f"""
SELECT {S.STATUS_COLS}, 'status_list:' || user_id || ':' || page_no AS page_key, page_no, pos
FROM posts WHERE {S.GOOD_POST}"""))
def q_extract_statuses(spark, sf):
    """Post cards -> statuses (promo and bad cards out)."""
    return ex.extract_statuses(status_pages(spark, sf))


@query("explode_cards", S.with_(S.POSTS, """
pg AS (SELECT user_id, page_no, count(*) AS n FROM posts GROUP BY 1, 2),
slots AS (
  SELECT user_id, page_no, CAST(0 AS BIGINT) AS pos, CAST(4 AS INTEGER) AS n_keys, true AS has_mblog FROM pg
  UNION ALL SELECT user_id, page_no, pos, CAST(5 AS INTEGER), true FROM posts
  UNION ALL SELECT user_id, page_no, CAST(n + 1 AS BIGINT), CAST(5 AS INTEGER), false FROM pg)
SELECT 'status_list:' || user_id || ':' || page_no AS page_key, pos, n_keys, has_mblog FROM slots"""))
def q_explode_cards(spark, sf):
    """Every card of every feed page with its position, key count and mblog test."""
    cards = ex.explode_cards(status_pages(spark, sf))
    return cards.select("page_key", "pos", F.size(F.json_object_keys("card")).alias("n_keys"),
                        F.array_contains(F.json_object_keys("card"), "mblog").alias("has_mblog"))


@query("drop_promo_cards", S.with_(S.POSTS, """
SELECT 'status_list:' || user_id || ':' || page_no AS page_key, count(*) + 2 AS n_cards, count(*) AS n_kept
FROM posts GROUP BY user_id, page_no"""))
def q_drop_promo_cards(spark, sf):
    """Per page, all cards vs cards left after dropping promo and label slots."""
    cards = ex.explode_cards(status_pages(spark, sf))
    kept = fl.drop_promo_cards(cards)
    total = cards.groupBy("page_key").agg(F.count(F.lit(1)).alias("n_cards"))
    left = total.join(kept.groupBy("page_key").agg(F.count(F.lit(1)).alias("n_kept")), "page_key", "left")
    return left.withColumn("n_kept", F.coalesce("n_kept", F.lit(0)))  # a page may keep nothing


@query("last_status_per_page", S.with_(S.POSTS, """
SELECT 'status_list:' || user_id || ':' || page_no AS page_key, arg_max(CAST(oid AS VARCHAR), pos) AS status_id,
       max(pos) AS pos, CAST(any_value(user_id) AS BIGINT) AS user_id
FROM posts WHERE NOT bad_date AND NOT no_text GROUP BY user_id, page_no"""))
def q_last_status_per_page(spark, sf):
    """The last post of each page (its comments are the ones asked for)."""
    return ln.last_status_per_page(ex.extract_statuses(status_pages(spark, sf)))


@query("statuses_per_user", S.with_(S.POSTS, f"""
SELECT CAST(user_id AS BIGINT) AS user_id, count(*) AS n_statuses FROM posts WHERE {S.GOOD_POST} GROUP BY 1"""))
def q_statuses_per_user(spark, sf):
    return ag.statuses_per_user(ex.extract_statuses(status_pages(spark, sf)))


@query("max_id_mark", S.with_(S.POSTS, f"""
SELECT page_no, max(CAST(user_id AS BIGINT)) AS max_id FROM posts
WHERE {S.GOOD_POST} AND mo = {WINDOW_MONTH} GROUP BY 1"""))
def q_max_id_mark(spark, sf):
    """Highest account id among emitted month-window posts, per page number."""
    cards = ex.status_cards(status_pages(spark, sf))
    posts = cards.where(~F.col("is_promo") & F.col("reject_reason").isNull() & (F.col("month") == WINDOW_MONTH))
    return ag.max_id_mark(posts, by=["page_no"])


@query("check_complete", S.with_(S.POSTS, """
SELECT NOT (bad_date OR no_text) AS complete, count(*) AS n FROM posts GROUP BY 1"""))
def q_check_complete(spark, sf):
    """Records lacking a declared field are refused (counts kept vs refused)."""
    cards = ex.status_cards(status_pages(spark, sf)).where(~F.col("is_promo")).select(*ex.STATUS_OUT)
    from pagelake.operators.audit import check_complete

    good = check_complete(cards).select(F.lit(True).alias("complete"))
    bad = check_complete(cards, rejects=True).select(F.lit(False).alias("complete"))
    return good.unionByName(bad).groupBy("complete").agg(F.count(F.lit(1)).alias("n"))
