"""Hand-made shapes the rendered pages don't have."""

import pytest
from conftest import page
from pyspark.sql import functions as F

from pagelake.functions import urls as U
from pagelake.operators import extract as ex
from pagelake.operators import filters as fl
from pagelake.operators import links as ln
from pagelake.operators import requests as rq
from pagelake.sources.seeds import read_id_list, zip_lists


def post(i, year=2024, **kw):
    mblog = {"created_at": f"Mon Apr 01 10:00:00 +0800 {year}", "id": str(i), "text": "t", "reposts_count": 1,
             "comments_count": 2, "attitudes_count": 3, **kw}
    return {"card_type": 9, "scheme": f"https://x/{i}?a", "mblog": mblog, "a": 1, "b": 2}


def feed(cards, seed="7", no=0):
    return page("status_list", {"ok": 1, "data": {"cards": cards}}, seed_key=seed, page_no=no)


def ids(df):
    return sorted(r.status_id for r in df.select("status_id").collect())


def test_text_and_list_cards_are_skipped(pages_df):
    pages = pages_df([feed([post(1), "a text card", [1, 2], post(2)]), feed([post(3), None, post(4)], no=1)])
    kept = fl.year_cutoff_pages(pages, 2023, strict=True)
    assert ids(kept) == ["1", "2", "3"]  # a null card is bad and ends its page
    cards = ex.explode_cards(pages)
    assert fl.drop_promo_cards(cards).count() == 5


def test_null_account_key(pages_df):
    pages = pages_df([feed([post(1), post(2, 2020), post(3)], seed=None), feed([post(4)], seed=None, no=1)])
    assert ids(fl.year_cutoff_pages(pages, 2023)) == ["1"]


def test_unreadable_counter_is_rejected(pages_df):
    from pagelake.operators.audit import quarantine

    pages = pages_df([feed([post(1, reposts_count="10k+"), post(2, comments_count="12"), post(3, attitudes_count=None)])])
    assert ids(ex.extract_statuses(pages)) == ["2", "3"]
    assert [(r.reason, r.pos) for r in quarantine(pages).collect()] == [("bad_counter", 0)]


def test_page_rejects(pages_df):
    from pagelake.operators.audit import quarantine

    cursor = {"max_id": None, "max_id_type": 0}
    pages = pages_df([
        page("status_list", None, page_key="a"), page("status_list", "<html>", page_key="b"),
        page("status_list", {"data": {"since": 1}}, page_key="c"), page("status_list", {"data": []}, page_key="d"),
        page("status_list", {"data": {"cards": []}}, page_key="e"),
        page("hot_comments", {"data": {"max_id": 1}}, page_key="f"), page("hot_comments", {"data": {"data": []}}, page_key="g"),
        page("hot_comments", {"data": {"data": []}}, page_key="h", page_no=1),
        page("hot_comments", {"data": {"data": [], **cursor}}, page_key="i", page_no=1)])
    got = {(r.page_key, r.reason) for r in quarantine(pages).where("source_table = 'raw_pages'").collect()}
    assert got == {("a", "null_body"), ("b", "body_not_json"), ("c", "no_cards"), ("d", "no_cards"),
                   ("f", "no_comment_list"), ("h", "no_cursor")}


def test_not_ok_false(pages_df):
    pages = pages_df([page("supertopic", {"ok": v}, seed_key=str(i)) for i, v in enumerate([0, False, "false", 1, "0", None])])
    assert sorted(r.seed_key for r in fl.drop_not_ok(pages).collect()) == ["2", "3", "5"]
    assert sorted(r.seed_key for r in fl.drop_not_ok(pages, strict_type=True).collect()) == ["2", "3", "4", "5"]


def test_lists_pair_by_line(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\n\n\t3 \n")
    (tmp_path / "b.txt").write_text("10\n20\n30\n")
    a, b = (read_id_list(spark, str(tmp_path / f), n) for f, n in (("a.txt", "x"), ("b.txt", "y")))
    assert sorted(map(tuple, zip_lists(a, b).collect())) == [(0, "1", "10"), (2, "3", "30")]


def test_null_in_null_out(spark):
    df = spark.createDataFrame([(None, None)], "id string, title string")
    r = df.select(U.comment_request("id").alias("c"), U.topic_search_request("title", 1).alias("t"),
                  U.next_comment_page("id", F.lit("5"), F.lit("0")).alias("n")).first()
    assert tuple(r) == (None, None, None)


def test_one_whole_request_stays(spark):
    rows = [("p2", "u", "b", 1, False), ("p1", "u", "a", 5, False), ("p3", "v", "c", 2, True), ("p4", "v", "c", 2, True)]
    df = spark.createDataFrame(rows, "from_page string, request_url string, kind string, priority int, dont_filter boolean")
    got = sorted(map(tuple, rq.dedupe_requests(df).collect()))
    assert got == [rows[1], rows[2], rows[3]]


def test_follow_up_pages_have_parents(pages_df, spark):
    first = "https://m.weibo.cn/comments/hotflow?id=5&mid=5"
    pages = pages_df([page("hot_comments", {}, page_key=f"k{i}", request_url=u)
                      for i, u in enumerate([first, first + "&max_id=9&max_id_type=0", "https://m.weibo.cn/other"])])
    req = spark.createDataFrame([(first, "77")], "request_url string, parent_user_id string")
    got = {r.page_key: r.parent_user_id for r in ln.attach_parent(pages, req).collect()}
    assert got == {"k0": "77", "k1": "77", "k2": None}


def test_relanded_sides_dont_multiply(spark):
    comments = spark.createDataFrame([("5", "c1"), ("5", "c2")], "father_status_id string, comment string")
    posts = spark.createDataFrame([("5", 1, None, "old"), ("5", 1, None, "text")],
                                  "status_id string, user_id long, created_ts timestamp, text string")
    assert ln.comments_with_status(comments, posts).count() == 2
    people = spark.createDataFrame([(None, "a", 1, "k1"), (None, "b", 2, "k2"), (3, "c", 1, "k3"), (3, "d", 2, "k4")],
                                   "user_id long, name string, fetched_at int, page_key string")
    assert sorted(r.name for r in ln.dedupe_latest(people, ["user_id"]).collect()) == ["a", "b", "d"]


def test_stream_limit_raises(spark, pages_df, tmp_path):
    from pagelake.streaming import streams as st

    src = str(tmp_path / "in")
    pages_df([feed([post(i)], seed=str(i)) for i in range(20)]).repartition(20).write.parquet(src)
    pages = st._source(spark, src, 1, "parquet")
    writer = pages.writeStream.format("parquet").option("path", str(tmp_path / "out")).outputMode("append")
    with pytest.raises(TimeoutError):
        st.run_to_end(writer, str(tmp_path / "ckpt"), timeout_s=0.2)
