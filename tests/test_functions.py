from urllib.parse import quote

from hypothesis import given, settings
from hypothesis import strategies as st

from pagelake.functions import json as J
from pagelake.functions import text as X
from pagelake.functions import time as TM
from pagelake.functions import urls as U


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols))
    return df.select(expr.alias("v")).collect()[0].v


def test_site_time_parse(spark):
    s = "Fri Nov 18 16:39:14 +0800 2022"
    row = spark.createDataFrame([(s,), ("刚刚",), ("not a date 20x",)], "s string").select(
        TM.created_ts("s").cast("string").alias("ts"), TM.created_year("s").alias("y"),
        TM.created_month("s").alias("m")).collect()
    assert row[0].ts == "2022-11-18 08:39:14" and row[0].y == 2022 and row[0].m == 11
    assert row[1].ts is None and row[1].y is None and row[1].m is None
    assert row[2].ts is None and row[2].m is None


def test_site_time_round_trip(spark):
    df = spark.sql("select timestamp'2022-11-18 08:39:14' t")
    assert df.select(TM.site_time_text("t").alias("s")).collect()[0].s == "Fri Nov 18 16:39:14 +0800 2022"


def test_safe_path_absent_null_and_default(spark):
    body = '{"data": {"a": {"b": 1}, "n": null, "s": "x"}}'
    assert one(spark, J.safe_path("j", ["data", "a", "b"]), j=body) == "1"
    assert one(spark, J.safe_path("j", ["data", "n"]), j=body) is None  # present, null
    assert one(spark, J.safe_path("j", ["data", "zz"]), j=body) == ""  # absent
    assert one(spark, J.safe_path("j", ["data", "s", "q"]), j=body) == ""  # parent not an object
    assert one(spark, J.safe_path("j", ["data", "zz"], default=None), j=body) is None


def test_counter(spark):
    df = spark.createDataFrame([("12",), ("23.0",), ("1.5",), ("many",), (None,)], "s string")
    assert [r.v for r in df.select(X.counter("s").alias("v")).collect()] == [12, 23, None, None, None]


def test_strip_query(spark):
    assert one(spark, X.strip_query("u"), u="https://m.example.com/d/11?x=1") == "https://m.example.com/d/11"
    assert one(spark, X.strip_query("u"), u="https://m.example.com/d/11") == "https://m.example.com/d/11"


def test_next_status_page(spark):
    base = "https://m.weibo.cn/api/container/getIndex?type=uid&value=1&containerid=107603"
    assert one(spark, U.next_status_page("u", "s"), u=base, s="1002") == base + "&since_id=1002"
    assert one(spark, U.next_status_page("u", "s"), u=base + "&since_id=99", s="1002") == base + "&since_id=1002"
    assert one(spark, U.next_status_page("u", "s"), u=base, s=None) is None


def test_next_comment_page(spark):
    exp = "https://m.weibo.cn/comments/hotflow?id=5&mid=5&max_id=77&max_id_type=0"
    assert one(spark, U.next_comment_page("i", "m", "t"), i="5", m="77", t="0") == exp
    assert one(spark, U.next_comment_page("i", "m", "t"), i="5", m="0", t="0") is None
    assert one(spark, U.next_comment_page("i", "m", "t"), i="5", m=None, t=None) is None


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Z9 /*~-_.#%&=+é片")), max_size=12))
def test_url_quote_matches_python(spark, s):
    assert one(spark, U.url_quote("s"), s=s) == quote(s, "utf-8")


def test_topic_search_request_titles(spark):
    for title in ["Brand #1", "a/b", "x*y", "t~z", "电影 名"]:
        got = one(spark, U.topic_search_request("t", 1), t=title)
        q = quote(f"100103type=38&q={title}&t=0", "utf-8")
        assert got == f"https://m.weibo.cn/api/container/getIndex?containerid={q}&page_type=searchall&page=1"


def test_has_key_and_count(spark):
    df = spark.createDataFrame([('{"a":1,"mblog":null}',), ("3",), ("nope",)], "j string")
    rows = df.select(J.key_count("j").alias("n"), J.has_key("j", "mblog").alias("h")).collect()
    assert (rows[0].n, rows[0].h) == (2, True)
    assert rows[1].h is None and rows[2].h is None
