"""Retry backlog, failure streaks, completeness, rejects."""

import datetime as dt

from pagelake.operators import audit as au

from conftest import page


def fetch_rows(statuses, url="u", key="s1"):
    t0 = dt.datetime(2024, 1, 1)
    return [page("profile", None, page_key=f"{url}:{i}", seed_key=key, request_url=url, http_status=s,
                 attempt=i + 1, fetched_at=t0 + dt.timedelta(minutes=i)) for i, s in enumerate(statuses)]


def test_retry_backlog_budget(spark, pages_df):
    rows = (fetch_rows([503] * 12, url="a") + fetch_rows([503] * 13, url="b") + fetch_rows([403], url="c")
            + fetch_rows([418, 200], url="d") + fetch_rows([404], url="e") + fetch_rows([200, 418], url="f"))
    out = {r.request_url: r for r in au.retry_backlog(pages_df(rows)).collect()}
    assert set(out) == {"a", "c", "f"}
    assert out["a"].retries_left == 1 and out["c"].retries_left == 12


def test_error_streaks_14_15_16(spark, pages_df):
    rows = (fetch_rows([500] * 14 + [200], key="x") + fetch_rows([500] * 15 + [200], key="y")
            + fetch_rows([200] + [500] * 16, key="z"))
    for i, r in enumerate(rows):
        r["page_key"] = f"k{i:04d}"
    got = {r.seed_key: r.length for r in au.error_streaks(pages_df(rows)).collect()}
    assert got == {"y": 15, "z": 16}


def test_check_complete(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    assert au.check_complete(df).count() == 1
    bad = sorted(tuple(r.missing_columns) for r in au.check_complete(df, rejects=True).collect())
    assert bad == [("x",), ("y",)]


def test_quarantine_reasons(spark, pages_df):
    rows = [page("status_list", {"ok": 1, "data": {"cards": [
        {"card_type": 9, "scheme": "s", "itemid": "i", "show_type": 0, "mblog": {"created_at": "??"}}]}},
        seed_key="1"),
        page("hot_comments", "not json", seed_key="2", parent_status_id="2"),
        page("profile", {"data": {"userInfo": {"id": 1}}}, seed_key="3")]
    got = {(r.source_table, r.reason) for r in au.quarantine(pages_df(rows)).collect()}
    assert got == {("statuses", "bad_created_at"), ("raw_pages", "body_not_json"), ("profiles", "missing_field")}


def test_missing_cursor_report(spark, pages_df):
    rows = [page("status_list", {"ok": 1, "data": {"cards": []}}, seed_key="1"),
            page("status_list", {"ok": 1, "data": {"cards": [], "cardlistInfo": {}}}, seed_key="2"),
            page("topic_name", {"data": {}}, seed_key="3")]
    got = {(r.kind, r.reason): r.n_pages for r in au.missing_cursor_report(pages_df(rows)).collect()}
    assert got == {("status_list", "no_cardlist"): 1, ("status_list", "no_since_id"): 1, ("topic_name", "no_ok"): 1}


def test_error_streaks_methods_agree(spark, pages_df):
    import random
    rnd = random.Random(3)
    rows = fetch_rows([500 if rnd.random() < 0.8 else 200 for _ in range(400)], key="a") + \
        fetch_rows([500 if rnd.random() < 0.7 else 200 for _ in range(300)], key="b")
    for i, r in enumerate(rows):
        r["page_key"] = f"k{i:04d}"
    df = pages_df(rows)
    a = sorted(tuple(r) for r in au.error_streaks(df, n=5).collect())
    b = sorted(tuple(r) for r in au.error_streaks(df, n=5, method="window").collect())
    assert a == b and len(a) > 0


def test_unset_fields_differ_from_null(spark, pages_df):
    def card(**mblog):
        return {"card_type": 9, "itemid": "i", "show_type": 0, "scheme": "s", "mblog": mblog}

    full = {"created_at": "x", "text": "t", "reposts_count": 1, "comments_count": 1, "attitudes_count": 1, "id": "5"}
    comment = {"created_at": "x", "text": "t", "like_count": 1, "total_number": 1, "user": {"id": 1, "screen_name": "n"}}
    rows = [page("status_list", {"data": {"cards": [card(**full), card(**{**full, "text": None}),
                                                    card(**{k: v for k, v in full.items() if k not in ("text", "id")}),
                                                    {"a": 1, "b": 2, "c": 3, "mblog": {}}, {k: v for k, v in card(**full).items() if k != "scheme"} | {"z": 1}]}},
                 page_key="s"),
            page("hot_comments", {"data": {"data": [comment, {**comment, "user": None}, {**comment, "like_count": None}, {"text": "t"},
                                                    {**comment, "user": {"id": 1}}, 7], "max_id": 0, "max_id_type": 0}}, page_key="c"),
            page("profile", {"data": {"userInfo": {"screen_name": None, "id": 1, "follow_count": 1, "followers_count": 1, "description": "",
                                                   "statuses_count": 1, "verified": True}}}, page_key="p"),
            page("profile", None, page_key="q"), page("hot_comments", None, page_key="d")]
    df = pages_df(rows)
    got = {(r.page_key, r.pos): r.unset for k in ("status_list", "hot_comments", "profile") for r in au.refused_records(df, k).collect()}
    fields = ["created_at", "text", "like_count", "total_number", "user"]
    assert got == {("s", 2): ["text", "id"], ("s", 4): ["scheme"], ("c", 3): ["created_at", "like_count", "total_number", "user", "user.id",
                                                                               "user.screen_name"],
                   ("c", 4): ["user.screen_name"], ("c", 5): [*fields, "user.id", "user.screen_name"], ("p", None): ["verified_reason"],
                   ("q", None): ["screen_name", "id", "follow_count", "followers_count", "description", "statuses_count", "verified"]}
    assert au.unset_fields(df, "status_list").count() == 4


def test_quarantine_and_requests_scan_each_kind_once(spark, pages_df):
    from pagelake.operators.requests import derived_requests
    import tempfile

    path = tempfile.mkdtemp(prefix="pl-pages-")
    pages_df(fetch_rows([200])).write.mode("append").parquet(path)
    pages = spark.read.schema(pages_df([]).schema).parquet(path)
    for df in (au.quarantine(pages), derived_requests(pages)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 4 and "Join" not in plan
