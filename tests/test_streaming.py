"""Streams equal their batch forms, also with pages landing out of order."""

import tempfile


from pagelake.operators import extract as ex
from pagelake.operators import filters as fl
from pagelake.streaming import streams as st

from conftest import page


def post(i, year):
    return {"card_type": 9, "itemid": str(i), "scheme": f"https://m.example.com/d/{i}", "show_type": 0,
            "mblog": {"id": str(i), "created_at": f"Fri Nov 18 16:39:14 +0800 {year}", "text": "t",
                      "reposts_count": 1, "comments_count": 2, "attitudes_count": 3}}


def feed(user, page_no, years):
    cards = [{"a": 1, "b": 2, "c": 3, "mblog": {}}] + [post(user * 100 + page_no * 10 + i, y) for i, y in enumerate(years)]
    return page("status_list", {"ok": 1, "data": {"cards": cards}}, seed_key=str(user), page_no=page_no)


def test_stream_take_until_out_of_order(spark, pages_df):
    pages = [feed(1, 0, [2022, 2021]), feed(1, 1, [2020, 2016, 2022]), feed(1, 2, [2022]),
             feed(2, 0, [2015]), feed(2, 1, [2022]), feed(3, 0, []), feed(3, 1, [2019])]
    batch = fl.year_cutoff(ex.status_cards(pages_df(pages)), 2017).select("status_id").collect()
    landing = tempfile.mkdtemp(prefix="pl-land-")
    # later pages land first, one file each
    for group in ([p for p in pages if p["page_no"] == 2], [p for p in pages if p["page_no"] == 1],
                  [p for p in pages if p["page_no"] == 0]):
        pages_df(group).coalesce(1).write.mode("append").parquet(landing)
    sink, ckpt = tempfile.mkdtemp(prefix="pl-sink-"), tempfile.mkdtemp(prefix="pl-ckpt-")
    st.stream_take_until(spark, landing, sink, ckpt, 2017, max_files=1)
    got = sorted(r.status_id for r in spark.read.parquet(sink).collect())
    assert got == sorted(r.status_id for r in batch) == ["100", "101", "110", "310"]


def test_stream_take_until_gaps_and_relanded_pages(spark, pages_df):
    again = page("status_list", {"ok": 1, "data": {"cards": [post(200, 2022), post(201, 2021)]}}, seed_key="1", page_no=0)
    files = [[feed(1, 2, [2016]), feed(2, 2, [2022]), feed(4, 3, [2022, 2016, 2022]), feed(9, 1, [2020])],
             [feed(1, 0, [2022, 2021]), feed(2, 0, [2022]), feed(4, 0, []), feed(4, 5, [2022]), feed(5, 0, [2022, 2016, 2022])],
             [again, feed(1, 1, [2020]), feed(3, 4, [2022]), feed(5, 0, [2022, 2016, 2022]), feed(5, 1, [2022])],
             [feed(1, 1, [2020]), feed(4, 2, [2019]), feed(4, 2, [2019])]]
    batch = fl.year_cutoff(ex.status_cards(pages_df(sum(files, []))), 2017).select("status_id").collect()
    landing = tempfile.mkdtemp(prefix="pl-land-")
    sink, ckpt = tempfile.mkdtemp(prefix="pl-sink-"), tempfile.mkdtemp(prefix="pl-ckpt-")
    for k, group in enumerate(files):
        pages_df(group).coalesce(1).write.mode("append").parquet(landing)
        st.stream_take_until(spark, landing, sink, ckpt, 2017, max_files=1, final=k == len(files) - 1)
    got = sorted(r.status_id for r in spark.read.parquet(sink).collect())
    assert got == sorted(r.status_id for r in batch)
    assert got.count("110") == 2 and {"100", "101", "200", "201", "220", "340", "430"} <= set(got)
    # the stream goes on after its end: a page that was missing is late, and nothing is written twice
    pages_df([feed(2, 1, [2022]), feed(4, 4, [2022])]).coalesce(1).write.mode("append").parquet(landing)
    st.stream_take_until(spark, landing, sink, ckpt, 2017, max_files=1)
    assert sorted(r.status_id for r in spark.read.parquet(sink).collect()) == sorted([*got, "210"])


def test_stream_error_streak(spark, pages_df):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [page("profile", None, page_key=f"k{i:03d}", seed_key="s", request_url="u",
                 http_status=(200 if i in (0, 20) else 500), attempt=1, fetched_at=t0 + dt.timedelta(minutes=i))
            for i in range(40)]
    landing = tempfile.mkdtemp(prefix="pl-land-")
    pages_df(rows[:10]).coalesce(1).write.mode("append").parquet(landing)
    pages_df(rows[10:]).coalesce(1).write.mode("append").parquet(landing)
    sink, ckpt = tempfile.mkdtemp(prefix="pl-sink-"), tempfile.mkdtemp(prefix="pl-ckpt-")
    st.stream_error_streak(spark, landing, sink, ckpt, n=15)
    got = spark.read.parquet(sink).orderBy("run").collect()
    assert [(r.run, r.alert_at.minute) for r in got] == [(1, 15), (2, 35)]


def test_stream_take_until_small_chunks(spark, pages_df):
    """Pages split over several Arrow chunks are released only when complete."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        test_stream_take_until_out_of_order(spark, pages_df)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_stream_new_commenters_watermark(spark, pages_df):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    c = {"created_at": "Sat Nov 19 10:00:00 +0800 2022", "text": "x", "like_count": 1, "total_number": 0}

    def cpage(i, users):
        body = {"ok": 1, "data": {"data": [dict(c, user={"id": u, "screen_name": "n"}) for u in users],
                                  "max_id": 0, "max_id_type": 0}}
        return page("hot_comments", body, seed_key=str(i), parent_status_id=str(i),
                    fetched_at=t0 + dt.timedelta(minutes=i))

    landing = tempfile.mkdtemp(prefix="pl-land-")
    pages_df([cpage(0, [1, 2]), cpage(1, [2, 3])]).coalesce(1).write.mode("append").parquet(landing)
    pages_df([cpage(2, [3, 4, 4])]).coalesce(1).write.mode("append").parquet(landing)
    sink, ckpt = tempfile.mkdtemp(prefix="pl-sink-"), tempfile.mkdtemp(prefix="pl-ckpt-")
    st.stream_new_commenters(spark, landing, sink, ckpt, max_files=1, watermark="1 hour")
    assert sorted(r.user_id for r in spark.read.parquet(sink).collect()) == [1, 2, 3, 4]


def test_landed_files_grow_with_the_cores(spark):
    """A micro-batch of a large input has a file for every core; a small input keeps its few files."""
    from pagelake.plans import q_stream as q

    for rows, least, most in ((120, 6, 7), (60_000, 6 * spark.sparkContext.defaultParallelism, 31)):
        landing = q._land(spark.range(rows).coalesce(1), tempfile.mkdtemp(prefix="pl-land-"))
        landed = spark.read.parquet(landing)
        assert landed.count() == rows and least <= len(landed.inputFiles()) <= most
