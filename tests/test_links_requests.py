"""Links, set operations and request tables on small hand-made frames."""

import datetime as dt

from pagelake.operators import links as ln
from pagelake.operators import requests as rq


def test_dedupe_requests_respects_dont_filter(spark):
    df = spark.createDataFrame([("a", "profile", True), ("a", "profile", True), ("b", "topic", False),
                                ("b", "topic", False), ("c", "topic", False)], "request_url string, kind string, dont_filter boolean")
    got = sorted(r.request_url for r in rq.dedupe_requests(df).collect())
    assert got == ["a", "a", "b", "c"]


def test_exclude_seen_only_where_marked(spark):
    req = spark.createDataFrame([("u1", "s", "1", True), ("u2", "s", "2", True), ("u3", "s", "1", False)],
                                "request_url string, store_key string, index_value string, duplicate_removal boolean")
    seen = spark.createDataFrame([("s", "1")], "store_key string, index_value string")
    assert sorted(r.request_url for r in ln.exclude_seen(req, seen).collect()) == ["u2", "u3"]


def test_attach_parent_fills_only_missing(spark):
    pages = spark.createDataFrame([("p1", "u1", None), ("p2", "u2", "kept")],
                                  "page_key string, request_url string, parent_status_id string")
    reqs = spark.createDataFrame([("u1", "s1"), ("u2", "s2")], "request_url string, parent_status_id string")
    got = {r.page_key: r.parent_status_id for r in
           ln.attach_parent(pages, reqs, context=("parent_status_id",)).collect()}
    assert got == {"p1": "s1", "p2": "kept"}
    # a URL requested twice: one whole row counts, pages stay single; no URL and no context column are no match
    twice = spark.createDataFrame([("u1", "s1", "a"), ("u1", "s2", None), (None, "s3", "b")],
                                  "request_url string, parent_status_id string, seed_key string")
    wide = pages.selectExpr("*", "CAST(NULL AS STRING) AS seed_key").union(
        spark.createDataFrame([("p3", None, None, None)], "page_key string, request_url string, parent_status_id string, seed_key string"))
    got = sorted((r.page_key, r.parent_status_id, r.seed_key) for r in
                 ln.attach_parent(wide, twice, context=("parent_status_id", "seed_key")).collect())
    assert got == [("p1", "s2", None), ("p2", "kept", None), ("p3", None, None)]
    assert ln.attach_parent(pages, twice.select("request_url"), context=("parent_status_id",)).count() == 2


def test_route_records_else_branch(spark):
    df = spark.createDataFrame([("weibocommentitem",), ("weibouseritem",), ("weibopeopleitem",),
                                ("weibostatusitem",), ("weibotopicitem",)], "type string")
    got = {r.type: r.route for r in ln.route_records(df).collect()}
    assert got == {"weibocommentitem": "comments", "weibouseritem": "people", "weibopeopleitem": "people",
                   "weibostatusitem": "statuses", "weibotopicitem": "statuses"}


def test_dedupe_latest_keeps_newest(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "old", t, "k0"), (1, "new", t + dt.timedelta(days=1), "k1"),
                                (2, "only", t, "k2")], "user_id long, name string, fetched_at timestamp, page_key string")
    got = {r.user_id: r.name for r in ln.dedupe_latest(df, ["user_id"]).collect()}
    assert got == {1: "new", 2: "only"}


def test_exclude_done_and_except_all(spark):
    seeds = spark.createDataFrame([("1",), ("2",), ("2",), ("3",)], "id string")
    done = spark.createDataFrame([("2",), ("9",)], "id string")
    assert sorted(r.id for r in ln.exclude_done(seeds, done).collect()) == ["1", "3"]
    assert sorted(r.id for r in ln.ids_minus_done(seeds, done).collect()) == ["1", "2", "3"]
