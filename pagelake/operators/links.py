"""Links between records, and set operations.

The original workload linked records by carrying ids from page to page; as
tables these are equi-joins.  No join here uses an explicit broadcast hint:
sides are broadcast only when AQE measures them under
``spark.sql.autoBroadcastJoinThreshold`` at run time, otherwise the join is a
sort-merge join that AQE may split for skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_parent(pages: DataFrame, requests: DataFrame, url: str = "request_url",
                  context: Sequence[str] = ("seed_key", "seed_name", "parent_user_id", "parent_status_id")) -> DataFrame:
    """Fill a page's request context from the request table where the page
    itself does not carry it.  A follow-up page (its URL is the first page's
    plus a cursor) has the first page's context.  Of a URL requested more than
    once one whole row counts, the greatest, so that pages are not multiplied."""
    given = [c for c in context if c in requests.columns]
    req = requests.where(F.col(url).isNotNull()).groupBy(F.col(url).alias("_first_url")) \
        .agg(F.max(F.struct(F.lit(0).alias("_any"), *given)).alias("_req"))
    req = req.select("_first_url", *[F.col("_req")[c].alias(f"_req_{c}") for c in given])
    first = F.substring_index(F.substring_index(F.col(url), "&max_id=", 1), "&since_id=", 1)
    joined = pages.join(req, first == F.col("_first_url"), "left").drop("_first_url")
    for c in context:
        if f"_req_{c}" in joined.columns:
            joined = joined.withColumn(c, F.coalesce(F.col(c), F.col(f"_req_{c}"))).drop(f"_req_{c}")
    return joined


def comments_with_status(comments: DataFrame, statuses: DataFrame) -> DataFrame:
    """Each comment with the post it is on (inner join on the post id)."""
    s = statuses.select(
        F.col("status_id").alias("father_status_id"), F.col("user_id").alias("status_user_id"),
        F.col("created_ts").alias("status_ts"), F.col("text").alias("status_text"))
    # a post landed twice must not double its comments: one whole row per post
    s = s.groupBy("father_status_id").agg(F.max(F.struct("status_ts", "status_user_id", "status_text")).alias("_s")) \
        .select("father_status_id", "_s.status_user_id", "_s.status_ts", "_s.status_text")
    return comments.join(s, "father_status_id", "inner")


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: str = "fetched_at",
                  tie: str | None = "page_key") -> DataFrame:
    """One row per key: the one with the greatest ``order`` (then ``tie``).

    ``max_by(struct(row), (order, tie))`` as a sort-based aggregate (rows of
    texts fit no hash buffer): each task sorts its rows by key, and partial
    aggregation keeps at most one row per key and task before the shuffle, so a
    key with very many copies costs no more than one row downstream.
    Rows that lack a key value are not copies of each other: all are kept.
    """
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    loose, df = df.where(~keyed), df.where(keyed)
    others = [c for c in df.columns if c not in keys]
    rank = F.struct(F.col(order), *( [F.col(tie)] if tie else []))
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in others]).select(*df.columns).union(loose)


def comment_people(comments: DataFrame, profiles: DataFrame) -> DataFrame:
    """Wide row: each comment plus its commenter's latest profile (left join;
    commenters without a landed profile keep NULL profile columns)."""
    latest = dedupe_latest(profiles, ["user_id"]) if "fetched_at" in profiles.columns else profiles
    p = latest.select(F.col("user_id").alias("comment_people_id"), "name", "follow_count", "followers_count",
                      "description", "statuses_count", "verified", "verified_reason")
    return comments.join(p, "comment_people_id", "left")


def commenter_statuses(statuses: DataFrame, comments: DataFrame) -> DataFrame:
    """Posts written by anyone who commented (semi join: each post once)."""
    who = comments.select(F.col("comment_people_id").alias("user_id")).where(F.col("user_id").isNotNull()).distinct()
    return statuses.join(who, "user_id", "left_semi")


def topics_for_films(films: DataFrame, titles: DataFrame, topics: DataFrame) -> DataFrame:
    """Film seed -> its title page -> its topic rows."""
    f = films.select(F.col("id").alias("weibo_movie_id"))
    t = titles.select(F.col("film_id").alias("weibo_movie_id"), F.col("title").alias("film_title")) \
        .groupBy("weibo_movie_id").agg(F.max("film_title").alias("film_title"))  # a title page landed twice is one
    return f.join(t, "weibo_movie_id", "inner").join(topics, "weibo_movie_id", "inner")


def last_status_per_page(statuses: DataFrame, page_key: str = "page_key") -> DataFrame:
    """The last post of each page (the one whose comments get asked for)."""
    return statuses.groupBy(page_key).agg(
        F.max_by("status_id", "pos").alias("status_id"), F.max("pos").alias("pos"),
        F.first("user_id").alias("user_id"))


def exclude_done(seeds: DataFrame, done: DataFrame, column: str = "id") -> DataFrame:
    """Seeds whose id is not in the done list (anti join on the text id)."""
    d = done.select(F.col(column).cast("string").alias("_done")).where(F.col("_done").isNotNull()).distinct()
    return seeds.join(d, F.col(column).cast("string") == F.col("_done"), "left_anti")


def ids_minus_done(seeds: DataFrame, done: DataFrame) -> DataFrame:
    """Set difference of whole rows, keeping duplicates (``EXCEPT ALL``)."""
    return seeds.exceptAll(done)


def exclude_seen(requests: DataFrame, seen: DataFrame) -> DataFrame:
    """Drop requests whose ``(store_key, index_value)`` is in a seen set; only
    requests marked ``duplicate_removal`` are checked."""
    check = requests.where(F.coalesce(F.col("duplicate_removal"), F.lit(False)))
    keep = requests.where(~F.coalesce(F.col("duplicate_removal"), F.lit(False)))
    s = seen.select("store_key", "index_value").distinct()
    return check.join(s, ["store_key", "index_value"], "left_anti").unionByName(keep)


def union_comment_pages(first: DataFrame, follow_up: DataFrame) -> DataFrame:
    """First pages and follow-up pages make one comments table."""
    return first.unionByName(follow_up, allowMissingColumns=True)


def route_records(records: DataFrame, type_col: str = "type",
                  routes: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Name the output of each record by its tag: comments, people, and
    everything else (the *else* branch takes every other tag)."""
    routes = routes or {"comments": ["weibocommentitem"], "people": ["weibopeopleitem", "weibouseritem"]}
    route = F.lit("statuses")
    for name, tags in reversed(list(routes.items())):
        route = F.when(F.col(type_col).isin(*tags), F.lit(name)).otherwise(route)
    return records.withColumn("route", route)
