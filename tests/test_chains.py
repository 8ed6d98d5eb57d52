"""Page order from cursors against plain Python walks."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelake.operators import chains
from pagelake.operators import extract as ex
from pagelake.operators import filters as fl
from pagelake.schemas import RAW_PAGES

from conftest import page
from test_streaming import post

BASE = "https://m.example.com/api?uid=1"


def feed_page(user, cursor, nxt, cards=(), **kw):
    body = {"ok": 1, "data": {"cardlistInfo": {} if nxt is None else {"since_id": nxt}, "cards": list(cards)}}
    url = BASE if cursor is None else f"{BASE}&since_id={cursor}"
    return page("status_list", body, seed_key=user, page_key=f"{user}:{cursor}", request_url=url, **{"page_no": None, **kw})


def order(df, kind="status_list"):
    return {r.page_key: (r.page_no, r.chain_pos, r.chain_head, r.chain_status) for r in chains.chain_order(df, kind).collect()}


def test_long_chain_pieces_and_circle(spark, pages_df):
    long = [feed_page("1", None if i == 0 else 9000 - i, 9000 - i - 1) for i in range(60)]
    del long[40]  # the page that names the cursor of the next one is missing
    rows = long + [feed_page("2", None, None), feed_page("3", 50, 49), feed_page("3", 49, None), feed_page("3", 70, None),
                   feed_page("4", None, 5), feed_page("4", 8, 7), feed_page("4", 7, 8), feed_page("4", 6, 7), feed_page(None, None, 3),
                   feed_page(None, 3, 3), feed_page("4", 5, "")]
    random.Random(3).shuffle(rows)
    got = order(pages_df(rows))
    assert got["1:None"] == (0, 0, "", "whole") and got["1:8961"] == (39, 39, "", "whole")
    assert got["1:8959"] == (40, 0, "8959", "broken") and got["1:8941"] == (58, 18, "8959", "broken")
    assert got["2:None"] == (0, 0, "", "whole")
    assert got["3:70"] == (0, 0, "70", "broken") and got["3:50"] == (1, 0, "50", "broken") and got["3:49"] == (2, 1, "50", "broken")
    assert got["4:5"] == (1, 1, "", "whole") and got["4:6"] == (2, 0, "6", "broken")
    assert got["None:3"] == (1, 1, "", "whole")
    # 7 is named by 6 and 8; the smaller cursor counts, so 8 follows 7
    assert got["4:7"] == (3, 1, "6", "broken") and got["4:8"] == (4, 2, "6", "broken")
    report = {(r.chain_key, r.chain_head): (r.chain_status, r.n_pages) for r in chains.broken_chains(pages_df(rows)).collect()}
    assert report == {("1", "8959"): ("broken", 19), ("3", "70"): ("broken", 1), ("3", "50"): ("broken", 2), ("4", "6"): ("broken", 3)}


def test_circle_is_reported(spark, pages_df):
    rows = [feed_page("1", 8, 7), feed_page("1", 7, 8), feed_page("1", 9, 5), feed_page("1", None, 4), feed_page("1", 4, None)]
    got = order(pages_df(rows))
    assert got["1:8"] == (3, None, None, "circle") and got["1:7"] == (4, None, None, "circle")
    assert got["1:9"] == (2, 0, "9", "broken") and got["1:4"][0] == 1
    kept = {r.page_key for r in chains.renumber(pages_df(rows), broken="drop").collect()}
    assert kept == {"1:None", "1:4"}
    assert chains.chain_order(pages_df(rows).limit(0)).collect() == []


def test_relanded_and_changed_pages(spark, pages_df):
    """A page landed again shares its number; a list that changed between two fetches gives two successors."""
    rows = [feed_page("1", None, 90), feed_page("1", None, 95, http_status=201), feed_page("1", 90, 80), feed_page("1", 95, 85),
            feed_page("1", 80, None), feed_page("1", 85, None)]
    got = order(pages_df(rows))
    assert {k: v[0] for k, v in got.items()} == {"1:None": 0, "1:95": 1, "1:90": 2, "1:85": 3, "1:80": 4}
    assert sorted(r.page_no for r in chains.renumber(pages_df(rows)).collect()) == [0, 0, 1, 2, 3, 4]


def test_comment_pages(spark, pages_df):
    def comments(post_id, cursor, nxt, **extra):
        url = f"https://m.example.com/comments/hotflow?id={post_id}&mid={post_id}" + (f"&max_id={cursor}&max_id_type=0" if cursor else "")
        data = {"data": []} if nxt is None else {"data": [], "max_id": nxt, "max_id_type": 0}
        return page("hot_comments", {"ok": 1, "data": data}, seed_key="s", parent_status_id=post_id, page_key=f"{post_id}:{cursor}",
                    request_url=url, page_no=None)

    rows = [comments("7", None, 30), comments("7", 30, 12), comments("7", 12, 0), comments("8", None, None), comments("8", 5, 0)]
    assert order(pages_df(rows), "hot_comments") == {
        "7:None": (0, 0, "", "whole"), "7:30": (1, 1, "", "whole"), "7:12": (2, 2, "", "whole"),
        "8:None": (0, 0, "", "whole"), "8:5": (1, 0, "5", "broken")}


CARDS = st.lists(st.sampled_from([2015, 2016, 2018, 2020, 2022]), max_size=4)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(CARDS, min_size=1, max_size=5), min_size=1, max_size=4), st.randoms())
def test_prefix_by_cursor_equals_prefix_by_number(spark, data, rnd):
    """The cutoff gives the same posts with page numbers and without."""
    rows, k = [], 10_000
    for u, pages in enumerate(data):
        cursors = [None, *(k - 10 * i for i in range(1, len(pages))), None]
        for p, years in enumerate(pages):
            cards = [post(f"{u}:{p}:{i}", y) for i, y in enumerate(years)]
            rows.append(feed_page(str(u), cursors[p], cursors[p + 1], cards, page_no=p))
    rnd.shuffle(rows)
    df = spark.createDataFrame([tuple(r[f.name] for f in RAW_PAGES.fields) for r in rows], RAW_PAGES)
    blind = df.withColumn("page_no", F.lit(None).cast("int"))
    ids = lambda d: sorted(r.status_id for r in d.collect())
    want = ids(fl.year_cutoff(ex.status_cards(df), 2017))
    assert ids(fl.year_cutoff_pages(df, 2017)) == want
    assert ids(fl.year_cutoff_pages(chains.renumber(blind), 2017)) == want
    wrong = df.withColumn("page_no", F.lit(7))
    assert ids(fl.year_cutoff(ex.status_cards(chains.renumber(wrong)), 2017)) == want


def test_numbers_of_hot_keys_and_written_steps(spark, pages_df, monkeypatch):
    """Keys above the bound are numbered as the others are, and a step writes only the nodes it moved."""
    rows = [feed_page(u, None if i == 0 else 900 - i, 900 - i - 1) for u, n in (("1", 40), ("2", 9), ("3", 1)) for i in range(n)
            if (u, i) != ("1", 33)] + [feed_page(None, None, 3), feed_page(None, 3, None)]
    random.Random(5).shuffle(rows)
    sizes, write = [], chains._written

    def counted(df, name):
        out = write(df, name)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(chains, "_written", counted)
    plain = order(pages_df(rows))
    steps = [n for name, n in sizes if name == "chain"]
    assert steps[0] == len(rows) and steps[1:] == sorted(steps[1:], reverse=True) and steps[-1] < 20
    monkeypatch.setattr(chains, "HOT_PAGES", 5, raising=False)
    assert order(pages_df(rows)) == plain
    assert plain["1:861"] == (38, 5, "866", "broken") and plain["None:3"] == (1, 1, "", "whole")
