"""Requests as data: which pages the landed pages ask for next, and which of
those are not landed yet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.functions.urls import (
    comment_request, next_comment_page, next_status_page, next_supertopic_page, profile_request,
    status_list_request, topic_search_request,
)
from pagelake.operators import extract as ex
from pagelake.operators.filters import drop_not_ok
from pagelake.session import fresh_dir

REQUEST_COLS = ["from_page", "request_url", "kind", "priority", "dont_filter"]


def _asked(url: Column, kind: str, priority: int, dont_filter: bool) -> Column:
    return F.struct(url.alias("request_url"), F.lit(kind).alias("kind"), F.lit(priority).alias("priority"),
                    F.lit(dont_filter).alias("dont_filter"))


def _inline(pages: DataFrame, requests: Column) -> DataFrame:
    """One row per request that a page's row has put together."""
    return pages.select(F.col("page_key").alias("from_page"), F.inline(requests)).where(F.col("request_url").isNotNull())


def _status_requests(pages: DataFrame, min_year: int | None) -> DataFrame:
    """Next page and the hot comments of the page's last good post; one parse."""
    p = pages.where(F.col("kind") == "status_list")
    d = F.from_json("body", f"struct<data: struct<cards: array<string>, cardlistInfo: {ex.MAP}>>")["data"]
    p = p.select("page_key", "seed_key", "page_no", "request_url", d["cards"].alias("_cards"),
                 ex.get(d["cardlistInfo"], "since_id").alias("since_id"))

    def classified(x):
        f = ex._status_fields(x["_m"], x["_mb"], x["card"])
        return F.struct(*[f[k].alias(k) for k in ("is_promo", "reject_reason", "status_id", "year")])

    p = p.select("page_key", "seed_key", "page_no", "request_url", "since_id",
                 F.filter(F.transform(ex.card_array(F.col("_cards")), classified), lambda x: ~x["is_promo"]).alias("_cards"))
    good = F.filter("_cards", lambda x: x["reject_reason"].isNull())
    last = F.when(F.size(good) > 0, F.element_at(good, -1)["status_id"])
    p = p.select("page_key", "seed_key", "page_no", "request_url", "since_id", last.alias("last_id"),
                 *([F.exists("_cards", lambda x: F.coalesce(x["year"] < min_year, F.lit(False))).alias("_stops")]
                   if min_year is not None else []))
    going = F.lit(True)
    if min_year is not None:  # the first page that holds an old post ends the account: read twice, so written
        path = fresh_dir(pages.sparkSession, "status-requests")
        p.write.parquet(path)
        p = pages.sparkSession.read.schema(p.schema).parquet(path)
        stops = p.where("_stops").groupBy(F.col("seed_key").alias("_key")).agg(F.min("page_no").alias("_stop_page"))
        p = p.join(stops, F.col("seed_key") == F.col("_key"), "left")
        going = F.col("_stop_page").isNull() | (F.col("page_no") < F.col("_stop_page"))
    following = F.when(going, next_status_page("request_url", "since_id"))
    return _inline(p, F.array(_asked(following, "status_list", 10, True),
                              _asked(comment_request("last_id"), "hot_comments", 0, True)))


def _comment_requests(pages: DataFrame, profile_per_comment: bool) -> DataFrame:
    """Next comment page and each commenter's profile; one parse."""
    p = ex.parsed_comment_pages(pages)
    d = F.col("_d")
    url = F.when(F.col("_has_cursor"), next_comment_page("parent_status_id", d["max_id"], d["max_id_type"]))
    asked = F.array(_asked(url, "hot_comments", 0, True))
    if profile_per_comment:
        good = F.filter(ex.comment_array(d["data"]), lambda x: ex.comment_reason(x["_c"], x["_u"]).isNull())
        profiles = F.transform(good, lambda x: _asked(
            profile_request(ex.get(x["_u"], "id").try_cast("bigint")), "profile", 10, True))
        asked = F.concat(asked, F.coalesce(profiles, F.array().cast(
            "array<struct<request_url: string, kind: string, priority: int, dont_filter: boolean>>")))
    return _inline(p, asked)


def _feed_requests(pages: DataFrame) -> DataFrame:
    """Next feed page, first topic search of a film title, next search page."""
    kind = F.col("kind")
    p = drop_not_ok(pages.where(kind.isin("supertopic", "topic_name", "topic_search")))
    since = F.get_json_object("body", "$.data.pageInfo.since_id")
    title = F.coalesce(F.get_json_object("body", "$.data.pageInfo.nick"), F.lit(""))
    return _inline(p, F.when(kind == "supertopic", F.array(_asked(next_supertopic_page("seed_key", since), "supertopic", 10, False)))
                   .when(kind == "topic_name", F.array(_asked(topic_search_request(title, 1), "topic_search", 10, False)))
                   .otherwise(F.array(_asked(topic_search_request("seed_name", F.col("page_no") + 1), "topic_search", 5, False))))


def derived_requests(pages: DataFrame, min_year: int | None = None,
                     profile_per_comment: bool = True) -> DataFrame:
    """Every request the landed pages imply, one row per (page, request).

    profile -> its post list; post-list page -> next page (unless the account
    has stopped at ``min_year`` on or before this page) and the hot comments
    of its last post; comment page -> next comment page and each commenter's
    profile; feed page -> next feed page; film title -> first topic search
    page; topic search page -> next page.

    Every kind is scanned and parsed once: a page's requests are put together
    as an array inside its row.
    """
    prof = ex.extract_profiles(pages, container=True)
    profiles = _inline(prof, F.array(_asked(status_list_request("request_url", "container_id"), "status_list", 10, True)))
    parts = [profiles, _status_requests(pages, min_year), _comment_requests(pages, profile_per_comment), _feed_requests(pages)]
    return reduce(DataFrame.unionByName, parts)


def dedupe_requests(requests: DataFrame) -> DataFrame:
    """A URL asked twice is kept twice when ``dont_filter`` is set, else once:
    the whole row that comes first (no mix of several rows)."""
    forced = requests.where(F.coalesce(F.col("dont_filter"), F.lit(False)))
    rest = requests.where(~F.coalesce(F.col("dont_filter"), F.lit(False)))
    others = [c for c in rest.columns if c != "request_url"]
    once = rest.groupBy("request_url").agg(F.min(F.struct(*others)).alias("_row")).select("request_url", "_row.*")
    return forced.unionByName(once.select(*requests.columns))


def missing_pages(pages: DataFrame, min_year: int | None = None) -> DataFrame:
    """Requests implied by landed pages whose URL is not landed (distinct)."""
    req = derived_requests(pages, min_year=min_year)
    landed = pages.select("request_url").where(F.col("request_url").isNotNull()).distinct()
    # group first: a URL asked by very many pages is one row in the join
    asked = req.groupBy("request_url", "kind").agg(F.max("priority").alias("priority"),
                                                   F.count(F.lit(1)).alias("n_asks"))
    return asked.join(landed, "request_url", "left_anti")
