"""Stateful streams: gaps, held pages, fetches out of order; and the tables that streams write."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from pagelake.operators import audit as au
from pagelake.operators import extract as ex
from pagelake.operators import filters as fl
from pagelake.sinks.versions import append_sink, read_current, upsert, upsert_sink
from pagelake.streaming import streams as st

from conftest import page
from test_streaming import feed, post

T0 = dt.datetime(2024, 1, 1)


def folders(*names):
    return [tempfile.mkdtemp(prefix=f"pl-{n}-") for n in names]


def ids(spark, sink):
    return sorted(r.status_id for r in spark.read.parquet(sink).collect())


def timed(user, number, years, minutes):
    return dict(feed(user, number, years), fetched_at=T0 + dt.timedelta(minutes=minutes))


def test_a_gap_is_given_up_when_the_clock_has_passed_it(spark, pages_df):
    landing, sink, ckpt = folders("land", "sink", "ckpt")

    def land(*rows):
        pages_df(list(rows)).coalesce(1).write.mode("append").parquet(landing)
        st.stream_take_until(spark, landing, sink, ckpt, 2017, max_files=1, final=False, delay="5 minutes", patience="1 hour")
        return ids(spark, sink)

    assert land(timed(1, 0, [2022], 0), timed(1, 2, [2021], 1)) == ["100"]
    assert land(timed(2, 0, [2022], 30)) == ["100", "200"]  # the clock is not yet an hour behind page 2
    assert land(timed(2, 1, [2022], 90)) == ["100", "120", "200", "210"]
    assert land(timed(1, 1, [2022, 2016], 91), timed(1, 3, [2022], 92)) == ["100", "110", "120", "200", "210"]


def test_many_held_pages(spark, pages_df):
    """Thousands of pages wait for the first one, over several batches, and none is lost."""
    n = 3_000
    rows = [page("status_list", {"ok": 1, "data": {"cards": [post(10_000 + k, 2022 if k < n - 5 else 2015)]}}, seed_key="1", page_no=k)
            for k in range(n)]
    later = rows[1:]
    random.Random(2).shuffle(later)
    landing, sink, ckpt = folders("land", "sink", "ckpt")
    for part in (later[:1_500], later[1_500:], rows[:1]):
        pages_df(part).coalesce(1).write.mode("append").parquet(landing)
    st.stream_take_until(spark, landing, sink, ckpt, 2017, max_files=1, final=False)
    assert ids(spark, sink) == sorted(str(10_000 + k) for k in range(n - 5))


def test_three_forms_of_the_prefix_agree(spark, pages_df):
    """Pages, cards and stream on random accounts: pages without numbers, pages landed twice, empty pages."""
    r, rows = random.Random(8), []
    for u in range(1, 13):
        for number in [None, *range(r.randint(1, 5))]:
            for _ in range(r.choice([1, 1, 2])):
                rows.append(dict(feed(u, 9 if number is None else number, r.choices([2022, 2020, 2016], [6, 3, 1], k=r.randint(0, 3))),
                                 page_no=number, page_key=f"{u}:{number}"))
    df = pages_df(rows)
    pages = sorted(x.status_id for x in fl.year_cutoff_pages(df, 2017).collect())
    cards = sorted(x.status_id for x in fl.year_cutoff(ex.status_cards(df), 2017).collect())
    assert pages == cards and None not in pages
    landing, sink, ckpt = folders("land", "sink", "ckpt")
    df.coalesce(1).write.mode("append").parquet(landing)
    st.stream_take_until(spark, landing, sink, ckpt, 2017)
    assert ids(spark, sink) == pages


def test_a_stop_on_an_unnumbered_page_ends_the_account(spark, pages_df):
    rows = [dict(feed(1, 0, [2022, 2010]), page_no=None), dict(feed(1, 1, [2022]), page_no=0)]
    assert [r.status_id for r in fl.year_cutoff_pages(pages_df(rows), 2017).collect()] == ["100"]


def profile(key, minutes, good=True, status=200):
    info = {"screen_name": "n", "id": 1, "follow_count": 1, "followers_count": 2, "description": "d", "statuses_count": 3, "verified": False}
    body = {"ok": 1, "data": {"userInfo": info, "tabsInfo": {"tabs": [{"containerid": "a"}, {"containerid": "b"}]}}} if good else {"ok": 0}
    return page("profile", body, page_key=key, seed_key=key.split(":")[0], http_status=status, fetched_at=T0 + dt.timedelta(minutes=minutes))


def test_profile_streaks_in_any_order_equal_the_batch_form(spark, pages_df):
    r = random.Random(5)
    rows = [profile(f"{r.randrange(20)}:{i}", i, r.random() < 0.45) for i in range(300)]
    rows += [profile("3:x", 400, status=500), page("status_list", None, seed_key="3", http_status=500, fetched_at=T0)]
    slices = spark.createDataFrame([(str(k), k % 3) for k in range(19)], "seed_key string, slice int")  # account 19 has none
    outcomes = au.profile_outcomes(pages_df(rows)).join(slices, "seed_key", "left")
    want = {(None if x.slice is None else str(x.slice), x.run, x.first_at)
            for x in au.error_streaks(outcomes, 4, by=("slice",), failed=F.col("failed"), method="window").collect()}
    assert len(want) > 5
    r.shuffle(rows)
    landing, sink, ckpt = folders("land", "sink", "ckpt")
    for part in (rows[:90], rows[90:200], rows[200:]):
        pages_df(part).coalesce(1).write.mode("append").parquet(landing)
    st.stream_profile_error_streak(spark, landing, sink, ckpt, slices, n=4, max_files=1, delay="1 day")
    got = spark.read.parquet(sink).collect()
    assert {(x.slice, x.run, x.first_at) for x in got} == want and len(got) == len(want)


def test_streaks_go_on_across_runs(spark, pages_df):
    """Without a final clock row the last stretch waits; the next run counts on from it."""
    landing, sink, ckpt = folders("land", "sink", "ckpt")
    slices = spark.createDataFrame([("1", 0)], "seed_key string, slice int")
    for k, part in enumerate(([1, 0, 2], [4, 3], [5])):
        pages_df([profile(f"1:{i}", i, good=False) for i in part]).coalesce(1).write.mode("append").parquet(landing)
        st.stream_profile_error_streak(spark, landing, sink, ckpt, slices, n=5, final=k == 2, delay="2 minutes")
    got = spark.read.parquet(sink).collect()
    assert [(x.slice, x.run, x.first_at.minute, x.alert_at.minute) for x in got] == [("0", 0, 0, 4)]


def test_upsert_versions(spark):
    (table,) = folders("table")
    frame = lambda rows: spark.createDataFrame(rows, "k string, v long")
    now = lambda: sorted((tuple(r) for r in read_current(spark, table).collect()), key=str)
    assert read_current(spark, table) is None
    assert upsert(frame([("a", 1), (None, 2)]), table, ["k"], "q", 0)
    assert upsert(frame([(None, 3), ("b", 4)]), table, ["k"], "q", 1)
    assert now() == [("a", 1), ("b", 4), (None, 3)]
    assert not upsert(frame([("a", 99)]), table, ["k"], "q", 1) and now() == [("a", 1), ("b", 4), (None, 3)]

    def killed():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        upsert(frame([("a", 50)]), table, ["k"], "q", 2, before_switch=killed)
    assert now() == [("a", 1), ("b", 4), (None, 3)]  # the version written is not the current one
    assert upsert(frame([("a", 50)]), table, ["k"], "q", 2) and ("a", 50) in now()
    assert upsert(frame([("c", 7)]), table, ["k"], "another query", 0) and len(now()) == 4
    held = read_current(spark, table)
    upsert_sink(table, ["k"], "q")(frame([("c", 8)]), 3)
    assert ("c", 7) in {tuple(r) for r in held.collect()} and ("c", 8) in now()  # a reader keeps its version


def test_append_batches_once(spark, pages_df):
    (table,) = folders("table")
    rows = spark.createDataFrame([("x", T0), ("x", T0), ("y", T0 + dt.timedelta(days=1))], "k string, fetched_at timestamp")
    sink = append_sink(table, "feed")
    sink(rows, 0)
    sink(rows, 0)
    sink(rows.limit(1), 1)
    got = spark.read.parquet(table)
    assert sorted((r.k, r.batch) for r in got.collect()) == [("x", 0), ("x", 0), ("x", 1), ("y", 0)]
    day = got.where("load_date = DATE'2024-01-02'")
    assert "PartitionFilters: [isnotnull(load_date" in day._jdf.queryExecution().executedPlan().toString() and day.count() == 1
    with pytest.raises(ValueError):
        append_sink(table, "a/b")(rows, 0)


def test_max_id_per_slice_in_updates(spark, pages_df):
    landing, table, ckpt = folders("land", "table", "ckpt")
    slices = spark.createDataFrame([("1", 0), ("2", 0), ("3", 1)], "seed_key string, slice int")
    for part, want in (([feed(1, 0, [2022]), feed(3, 0, [2022])], {0: 1, 1: 3}), ([feed(2, 0, [2022]), feed(1, 1, [2022]), feed(9, 0, [2022])],
                                                                                  {0: 2, 1: 3, None: 9})):
        pages_df(part).coalesce(1).write.mode("append").parquet(landing)
        st.stream_max_id(spark, landing, table, ckpt, slices=slices)
        assert {r.slice: r.max_id for r in read_current(spark, table).collect()} == want
