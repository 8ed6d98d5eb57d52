"""Landing the test pages: kinds on demand, one shuffle, hot keys, files of a stream's folder."""

import datetime as dt
import os

import pytest

from pagelake.plans import fixtures as fx
from pagelake.plans import q_stream as qs

WHEN = dt.datetime(1998, 4, 5, 6, 7, 8)


def orders(spark, accounts=(1, 1, 2, None)):
    rows = [(i, accounts[i % len(accounts)], WHEN, 1000.25 + i, ["1-URGENT", "3-MEDIUM", "5-LOW"][i % 3], "PFO"[i % 3])
            for i in range(90)]
    return spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double, "
                                       "o_orderpriority string, o_orderstatus string")


def lineitem(spark):
    rows = [(i % 7 if i % 11 else None, i % 3, i, i % 5, 10.0 + i, WHEN, 1.0 + i, (i % 4) / 10, (i % 3) / 10) for i in range(80)]
    return spark.createDataFrame(rows, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_extendedprice double, "
                                       "l_shipdate timestamp, l_quantity double, l_discount double, l_tax double")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def tables(spark, tmp_path):
    for name, df in {"orders": orders(spark), "lineitem": lineitem(spark)}.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_only_the_kinds_that_are_read_are_landed(spark, tables):
    assert fx.landed(spark, tables, ["status_list"]).count() > 0
    path = fx.landing(spark, tables, ["status_list"])
    assert [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("kind=")] == ["kind=status_list"]  # customer is not even there
    assert fx.landed(spark, tables, ["hot_comments"]).select("kind").distinct().collect() == [("hot_comments",)]
    assert fx.landing(spark, tables, ["status_list", "hot_comments"]) == path


def test_pages_are_rendered_after_one_shuffle_of_narrow_rows(spark):
    plan = fx.status_pages(orders(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
    plan = fx.comment_pages(lineitem(spark), orders(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(l_orderkey") <= 2, plan  # comments, posts


def test_hot_keys_give_the_same_pages(spark, monkeypatch):
    plain = rows_of(fx.status_pages(orders(spark))), rows_of(fx.comment_pages(lineitem(spark), orders(spark)))
    assert len(plain[0]) == 5 + 3  # accounts of 45 and 22 posts; posts without an account are left out
    monkeypatch.setattr(fx, "HOT_ROWS", 11)
    assert (rows_of(fx.status_pages(orders(spark))), rows_of(fx.comment_pages(lineitem(spark), orders(spark)))) == plain


def test_stream_folder_is_written_by_the_tasks_that_read(spark, tmp_path):
    folder = str(tmp_path / "land")
    df = fx.status_pages(orders(spark, tuple(range(20)))).repartition(9)
    assert qs._land(df, folder) == folder
    n = len([f for f in os.listdir(folder) if f.endswith(".parquet")])
    assert n >= 9  # not gathered into six
    assert qs._per_batch(spark, folder) == -(-n // 3)
    one = str(tmp_path / "one")
    qs._land(df.coalesce(1), one)
    assert len([f for f in os.listdir(one) if f.endswith(".parquet")]) >= 6
