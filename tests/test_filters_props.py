"""Order-sensitive operators against plain Python loops (property tests)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelake.operators import filters as fl

CARD = st.tuples(st.sampled_from([2015, 2016, 2017, 2018, 2023, 2024, None]),
                 st.integers(1, 12), st.booleans(), st.booleans())  # year, month, promo, bad


def accounts():
    page = st.lists(CARD, min_size=0, max_size=4)
    return st.lists(st.lists(page, min_size=1, max_size=3), min_size=1, max_size=4)


def rows_of(data):
    rows = []
    for u, pages in enumerate(data):
        for p, cards in enumerate(pages):
            for i, (y, m, promo, bad) in enumerate(cards):
                reason = "bad_created_at" if y is None else ("missing_field" if bad else None)
                rows.append((str(u), f"{u}:{p}", p, i, f"{u}:{p}:{i}", promo, y, m if y else None, reason))
    return rows


SCHEMA = "seed_key string, page_key string, page_no int, pos long, key string, is_promo boolean, year int, month int, reject_reason string"


def py_year_cutoff(data, min_year, strict):
    out = []
    for u, pages in enumerate(data):
        stopped = False
        for p, cards in enumerate(pages):
            for i, (y, m, promo, bad) in enumerate(cards):
                if promo:
                    continue
                if y is None:
                    if strict:
                        break  # bad card ends its page
                    continue
                if y < min_year:
                    stopped = True
                    break
                if bad:
                    if strict:
                        break
                    continue
                out.append(f"{u}:{p}:{i}")
            if stopped:
                break
    return sorted(out)


def py_month_window(data, min_year, month, strict):
    out = []
    for u, pages in enumerate(data):
        stopped = False
        for p, cards in enumerate(pages):
            for i, (y, m, promo, bad) in enumerate(cards):
                if promo:
                    continue
                if y is None:
                    if strict:
                        break
                    continue
                if y < min_year or m < month:
                    stopped = True
                    break
                if m == month:
                    if bad:
                        if strict:
                            break
                        continue
                    out.append(f"{u}:{p}:{i}")
            if stopped:
                break
    return sorted(out)


@settings(max_examples=30, deadline=None)
@given(accounts(), st.sampled_from([2017, 2020]), st.booleans())
def test_year_cutoff_matches_loop(spark, data, min_year, strict):
    df = spark.createDataFrame(rows_of(data), SCHEMA)
    got = sorted(r.key for r in fl.year_cutoff(df, min_year, strict=strict).collect())
    assert got == py_year_cutoff(data, min_year, strict)


@settings(max_examples=30, deadline=None)
@given(accounts(), st.booleans())
def test_month_window_matches_loop(spark, data, strict):
    df = spark.createDataFrame(rows_of(data), SCHEMA)
    got = sorted(r.key for r in fl.month_window(df, 2023, 4, strict=strict).collect())
    assert got == py_month_window(data, 2023, 4, strict)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40), st.booleans()), max_size=60, unique_by=lambda t: (t[0], t[1])))
def test_take_until_join_equals_window_and_loop(spark, rows):
    df = spark.createDataFrame(rows or [(0, 0, False)], "k int, o int, s boolean")
    if not rows:
        df = df.limit(0)
    a = sorted(tuple(r) for r in fl.take_until(df, ["k"], ["o"], F.col("s")).collect())
    b = sorted(tuple(r) for r in fl.take_until(df, ["k"], ["o"], F.col("s"), method="window").collect())
    exp = []
    for k in {r[0] for r in rows}:
        for r in sorted([r for r in rows if r[0] == k], key=lambda r: r[1]):
            if r[2]:
                break
            exp.append(r)
    assert a == b == sorted(exp)


def test_on_allowed_domain(spark):
    df = spark.createDataFrame([("https://w.example.cn/x", False), ("http://m.example.cn:8080/y", False),
                                ("https://example.cn", False), ("https://badexample.cn/", False),
                                ("https://other.org/", True)], "u string, d boolean")
    kept = [r.u for r in fl.on_allowed_domain(df, "u", ["example.cn"], dont_filter_col="d").collect()]
    assert kept == ["https://w.example.cn/x", "http://m.example.cn:8080/y", "https://example.cn",
                    "https://other.org/"]


def test_id_at_least(spark):
    df = spark.createDataFrame([("5",), ("12",), ("x",)], "id string")
    assert [r.id for r in fl.id_at_least(df, "id", 10).collect()] == ["12"]


def test_page_local_strict_equals_shuffle_strict(spark, pages_df):
    from conftest import page
    from pagelake.operators import extract as ex

    def post(i, year, text=True):
        mb = {"id": str(i), "created_at": f"Fri Nov 18 16:39:14 +0800 {year}", "reposts_count": 1,
              "comments_count": 2, "attitudes_count": 3}
        if text:
            mb["text"] = "t"
        return {"card_type": 9, "itemid": str(i), "scheme": "s", "show_type": 0, "mblog": mb}

    pages = [page("status_list", {"ok": 1, "data": {"cards": [post(1, 2022), post(2, "x"), post(3, 2022)]}},
                  seed_key="1", page_no=0),
             page("status_list", {"ok": 1, "data": {"cards": [post(4, 2022), post(5, 2015, text=False)]}},
                  seed_key="1", page_no=1),
             page("status_list", {"ok": 1, "data": {"cards": [post(6, 2022, text=False), post(7, 2022)]}},
                  seed_key="2", page_no=0),
             page("status_list", {"ok": 1, "data": {"cards": [post(8, 2022)]}}, seed_key="2", page_no=1)]
    df = pages_df(pages)
    a = sorted(r.status_id for r in fl.year_cutoff_pages(df, 2017, strict=True).collect())
    b = sorted(r.status_id for r in fl.year_cutoff(ex.status_cards(df), 2017, strict=True).collect())
    assert a == b == ["1", "4", "8"]


@settings(max_examples=15, deadline=None)
@given(accounts())
def test_month_window_pages_strict_matches_loop(spark, data):

    from conftest import page
    from pagelake.schemas import RAW_PAGES

    months = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    rows = []
    for u, pages in enumerate(data):
        for p, cards in enumerate(pages):
            out = []
            for i, (y, m, promo, bad) in enumerate(cards):
                if promo:
                    out.append({"a": 1, "b": 2, "c": 3, "mblog": {}})
                    continue
                date = f"Fri {months[m - 1]} 18 16:39:14 +0800 {y}" if y else "just now"
                mb = {"id": f"{u}:{p}:{i}", "created_at": date, "reposts_count": 1, "comments_count": 2,
                      "attitudes_count": 3}
                if not bad:
                    mb["text"] = "t"
                out.append({"card_type": 9, "itemid": "x", "scheme": "s", "show_type": 0, "mblog": mb})
            rows.append(page("status_list", {"ok": 1, "data": {"cards": out}}, seed_key=str(u), page_no=p))
    df = spark.createDataFrame([tuple(r[f.name] for f in RAW_PAGES.fields) for r in rows], RAW_PAGES)
    got = sorted(r.status_id for r in fl.month_window_pages(df, 2023, 4, strict=True).collect())
    assert got == py_month_window(data, 2023, 4, True)
