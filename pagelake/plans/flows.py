"""End-to-end flows over landed pages, as compositions of the operators.

E1 ``actor_feeds``: a ranked slice of accounts -> profiles, posts (until the
cutoff year, if one is given), and the hot comments of each page's last post.
E2 ``commenter_feeds``: status seeds -> their comments -> distinct commenters
minus the done list -> a share of them -> the commenters' posts in the month
window or until the cutoff year.
Feeds ``supertopic_feeds``: feed seeds -> feed pages -> posts and the next
pages they ask for.
E3 ``film_topics``: film seeds -> film titles -> topic search results.

Each returns DataFrames; nothing is collected.  Per-account work is keyed by
the account id, so an account with many pages costs one aggregate row before
any join (see ``take_until``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.operators import aggregates as ag
from pagelake.operators import extract as ex
from pagelake.operators import filters as fl
from pagelake.operators import links as ln
from pagelake.operators import ordinal as od


def actor_feeds(pages: DataFrame, accounts: DataFrame, lo: int, hi: int,
                min_year: int | None = None) -> dict[str, DataFrame]:
    """``accounts``: ``(ordinal, id, n_posts)`` (an id list zipped with counts).
    Without ``min_year`` every good post is kept."""
    chosen = od.rank_slice(accounts, "n_posts", lo, hi).select(F.col("id").alias("seed_key"))
    mine = pages.join(chosen, "seed_key", "left_semi")
    profiles = ex.extract_profiles(mine)
    statuses = ex.extract_statuses(mine) if min_year is None else fl.year_cutoff_pages(mine, min_year)
    last = ln.last_status_per_page(statuses)
    comment_pages = pages.where(F.col("kind") == "hot_comments").join(
        last.select(F.col("status_id").alias("parent_status_id")), "parent_status_id", "left_semi")
    return {"profiles": profiles, "statuses": statuses.select(*ex.STATUS_OUT),
            "comments": ex.extract_comments(comment_pages)}


def work_share(ids: DataFrame, share: int | None = None, shares: int = od.SHARES, resume_at: int | None = None) -> DataFrame:
    """What one worker takes of a set of ids: sorted as text, cut into
    ``shares``, the first part of the upper shares skipped, one ``share`` kept
    (all with None), and only ids from ``resume_at`` on."""
    placed = od.add_ordinal(ids.select(F.col("id").cast("string").alias("id")), ["id"], length="_len")
    cut = od.skip_fraction(od.fraction_slice(placed, shares, k=share), shares)
    if resume_at is not None:
        cut = fl.id_at_least(cut, "id", resume_at)
    return cut.select("id", "share")


def commenter_feeds(pages: DataFrame, seeds: DataFrame, done: DataFrame, min_year: int,
                    month: int | None = None, share: int | None = None, shares: int | None = None,
                    resume_at: int | None = None) -> dict[str, DataFrame]:
    """``seeds``: ``(statues_id, user_id)``; ``done``: ``(id)``.  With
    ``shares`` the commenters are cut as by ``work_share``.  Without ``month``
    posts run until the cutoff year."""
    on_seeds = pages.where(F.col("kind") == "hot_comments").join(
        seeds.select(F.col("statues_id").alias("parent_status_id")).distinct(), "parent_status_id", "left_semi")
    comments = ex.extract_comments(on_seeds)
    commenters = ag.distinct_commenters(comments).select(F.col("user_id").cast("string").alias("id"))
    todo = ln.exclude_done(commenters, done)
    if shares is not None:
        todo = work_share(todo, share, shares, resume_at)
    feeds = pages.where(F.col("kind") == "status_list").join(
        todo.select(F.col("id").alias("seed_key")), "seed_key", "left_semi")
    posts = fl.year_cutoff_pages(feeds, min_year) if month is None else fl.month_window_pages(feeds, min_year, month)
    return {"comments": comments, "commenters": todo, "statuses": posts.select(*ex.STATUS_OUT)}


def supertopic_feeds(pages: DataFrame, seeds: DataFrame) -> dict[str, DataFrame]:
    """``seeds``: ``(id)`` feed seed set.  ``requests``: the next page of every
    landed page that names one."""
    from pagelake.functions.urls import next_supertopic_page
    from pagelake.operators.requests import dedupe_requests

    mine = pages.where(F.col("kind") == "supertopic").join(
        seeds.select(F.col("id").alias("seed_key")).distinct(), "seed_key", "left_semi")
    since = F.get_json_object("body", "$.data.pageInfo.since_id")
    asked = fl.drop_not_ok(mine).select(next_supertopic_page("seed_key", since).alias("request_url"),
                                        F.lit("supertopic").alias("kind"), F.lit(False).alias("dont_filter"))
    return {"posts": ex.extract_supertopic_posts(mine),
            "requests": dedupe_requests(asked.where(F.col("request_url").isNotNull()))}


def film_topics(pages: DataFrame, films: DataFrame) -> dict[str, DataFrame]:
    """``films``: ``(id)`` film seed set."""
    titles = ex.extract_topic_title(pages)
    topics = ln.topics_for_films(films, titles, ex.extract_topics(pages))
    per_film = topics.groupBy("weibo_movie_id", "film_title").agg(F.count(F.lit(1)).alias("n_topics"))
    return {"titles": titles, "topics": topics, "per_film": per_film}


def land_status_silver(pages: DataFrame, path: str) -> str:
    """Bronze -> silver: every post-list card, classified, appended once to a
    Parquet table (partitioned by load date).  Order-sensitive operators then
    read silver: the stop side of ``take_until`` becomes a column-pruned scan
    of (seed_key, page_no, pos, year) instead of a second parse of the pages."""
    from pagelake.sinks.tables import append_table

    cards = ex.status_cards(pages).drop("card")
    append_table(cards, path)
    return path


def statuses_until_silver(spark, silver_path: str, min_year: int) -> DataFrame:
    """Posts until the cutoff year, computed from the silver card table."""
    cards = spark.read.parquet(silver_path)
    return fl.year_cutoff(cards, min_year).select(*ex.STATUS_OUT)
