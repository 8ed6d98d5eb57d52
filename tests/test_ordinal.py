"""Global positions and work shares against Python list slicing."""

import pytest
from pyspark.sql import functions as F

from pagelake.operators import ordinal as od


@pytest.fixture
def no_coalesce(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_add_ordinal_many_partitions(spark, no_coalesce):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"))
    out = od.add_ordinal(df, ["v"], partitions=13, length="n").orderBy("ordinal").collect()
    assert [r.ordinal for r in out] == list(range(5000))
    assert [r.v for r in out] == sorted(range(5000))
    assert {r.n for r in out} == {5000}


def test_sort_ids_is_text_order(spark):
    df = spark.createDataFrame([("9",), ("10",), ("1",)], "id string")
    assert [r.id for r in od.sort_ids(df).orderBy("ordinal").collect()] == ["1", "10", "9"]


@pytest.mark.parametrize("length", [0, 1, 31, 32, 33, 97, 1000])
def test_fraction_and_skip_match_python(spark, length):
    ids = [str(i) for i in range(length)]
    if length == 0:
        df = spark.createDataFrame([], "id string")
    else:
        df = spark.createDataFrame([(i,) for i in ids], "id string")
    lst = od.add_ordinal(df, [F.col("id").cast("int")], length="_len")
    shares = {r.id: r.share for r in od.fraction_slice(lst).collect()}
    kept = {r.id for r in od.skip_fraction(od.fraction_slice(lst)).collect()}
    exp_kept = set()
    for k in range(32):
        sub = ids[int(length * (k / 32)): int(length * ((k + 1) / 32))]
        for x in sub:
            assert shares[x] == k
        if k >= 16:
            sub = sub[int(len(sub) * 0.15):]
        exp_kept |= set(sub)
    assert kept == exp_kept


def test_fraction_slice_full_list_length(spark):
    n = 244078
    lst = od.add_ordinal(spark.range(n).select(F.col("id")), ["id"], length="_len")
    got = od.fraction_slice(lst).groupBy("share").agg(F.min("id").alias("lo"), F.count("*").alias("c"))
    got = {r.share: (r.lo, r.c) for r in got.collect()}
    for k in range(32):
        lo, hi = int(n * (k / 32)), int(n * ((k + 1) / 32))
        assert got[k] == (lo, hi - lo)


def test_rank_slice_is_stable(spark):
    counts = [5, 1, 5, 0, 1, 5, 2]
    df = spark.createDataFrame([(i, str(100 + i), c) for i, c in enumerate(counts)], "ordinal long, id string, n long")
    got = [r.id for r in od.rank_slice(df, "n", 2, 5).orderBy("rank").collect()]
    order = sorted(range(len(counts)), key=lambda k: counts[k])[2:5]
    assert got == [str(100 + i) for i in order]


def test_fixed_slice(spark):
    df = spark.createDataFrame([(0,), (4880,), (4881,), (244049,), (244050,), (244077,), (244078,)], "ordinal long")
    rows = od.fixed_slice(df).orderBy("ordinal").collect()
    assert [(r.slice, r.sub, r.covered) for r in rows] == [
        (0, 0, True), (0, 0, True), (0, 1, True), (0, 49, True), (0, 50, False), (0, 50, False), (1, 0, True)]


def test_keyed_running_count_splits_hot_key(spark, no_coalesce):
    import random
    rnd = random.Random(7)
    rows = [("hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 5)}", i, rnd.random() < 0.4) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t long, f boolean").repartition(11)
    got = {(r.k, r.t): r.running for r in od.keyed_running_count(df, ["k"], ["t"], F.col("f")).collect()}
    seen = {}
    for k, t, f in sorted(rows, key=lambda r: (r[0], r[1])):
        seen[k] = seen.get(k, 0) + int(f)
        assert got[(k, t)] == seen[k]


def test_keyed_running_max(spark):
    import random

    from pagelake.operators.ordinal import keyed_running_max

    r = random.Random(1)
    rows = [(r.choice(["hot", "hot", "hot", "b", None]), i, r.choice([None, r.randrange(1000)])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(4)
    got = {x.i: x.m for x in keyed_running_max(df, ["k"], ["i"], F.col("v"), "m").collect()}
    top = {}
    for k, i, v in rows:
        if v is not None:
            top[k] = max(v, top.get(k, v))
        assert got[i] == top.get(k)
