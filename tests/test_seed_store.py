"""The id set across runs: answers, filter, plan, totals."""

import tempfile

import pytest
from pyspark.sql import functions as F

from pagelake.sources.seed_store import SeedStore, estimated_union


@pytest.fixture
def store(spark):
    return SeedStore(spark, tempfile.mkdtemp(prefix="pl-seeds-") + "/set", buckets=4, bits=1 << 20)


def frame(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_insert_answers_like_a_set(spark, store):
    assert ids(store.insert(frame(spark, ["3", "1", "1", None, "", "é"]))) == ["", "1", "3", "é"]
    assert ids(store.insert(frame(spark, ["1", "2", "2", None]))) == ["2"]
    assert ids(store.insert(frame(spark, ["1", "2", "3", "é"]))) == []
    assert ids(store.insert(frame(spark, []))) == []
    numbers = spark.range(5).withColumnRenamed("id", "user_id")
    assert ids(store.insert(numbers, "user_id")) == ["0", "4"]
    assert ids(store.ids()) == ["", "0", "1", "2", "3", "4", "é"]


def test_another_session_finds_the_set(spark, store):
    store.insert(frame(spark, map(str, range(100))))
    spark.sql(f"DROP TABLE {store.table}")  # a later session knows the folder only
    again = SeedStore(spark, store.path, buckets=4, bits=1 << 20)
    assert ids(again.insert(frame(spark, ["99", "100"]))) == ["100"] and again.ids().count() == 101


def test_a_repeated_insert_gives_its_answer_again(spark, store):
    assert ids(store.insert(frame(spark, ["a", "b"]), name="run-1")) == ["a", "b"]
    assert ids(store.insert(frame(spark, ["a", "b"]), name="run-1")) == ["a", "b"]
    assert ids(store.insert(frame(spark, ["a", "b"]), name="run-2")) == []
    assert store.ids().count() == 2


def test_a_run_that_dies_on_the_way(spark, store):
    """The answer is written and the bits are set, but the ids are not in the set yet."""
    frame(spark, ["a", "b"]).write.parquet(f"{store.path}/answers/run-1")
    store._slots(frame(spark, ["a", "b"])).groupBy("slot").agg(F.bitmap_construct_agg("position").alias("bits")) \
        .write.mode("append").parquet(f"{store.path}/bits")
    assert ids(store.maybe_known(frame(spark, ["a", "x"]))) == ["a"] and ids(store.known(frame(spark, ["a", "x"]))) == []
    assert ids(store.insert(frame(spark, ["a", "b"]), name="run-1")) == ["a", "b"]
    assert ids(store.insert(frame(spark, ["a", "b", "c"]), name="run-2")) == ["c"]


def test_filter_and_plan(spark, store):
    store.insert(spark.range(2_000).select(F.col("id").cast("string")))
    store.insert(spark.range(2_000, 3_000).select(F.col("id").cast("string")))
    others = spark.range(10_000, 20_000).select(F.col("id").cast("string").alias("id"))
    assert store.maybe_known(others).count() < 200  # 6,000 bits of 2^20, two hashes: 1 in 30,000 by chance
    assert store.known(spark.range(3_500).select(F.col("id").cast("string").alias("id"))).count() == 3_000
    plan = store.known(others)._jdf.queryExecution().executedPlan().toString()
    right = plan[plan.index("SortMergeJoin"):].split("FileScan parquet")
    assert "Bucketed: true" in right[2] and right[0].count("Exchange hash") == 1 and "Exchange" not in right[1]  # only the candidates are shuffled


def test_totals_and_sketches(spark, store):
    store.insert(frame(spark, ["a", "b", "b"]), added_on="2024-01-01")
    store.insert(frame(spark, ["b", "c"]), added_on="2024-01-01")
    store.insert(frame(spark, ["c", "d"]), added_on="2024-01-03")
    got = [(str(r.added_on), r.n_given, r.n_new, r.n_ids) for r in store.totals().orderBy("added_on").collect()]
    assert got == [("2024-01-01", 5, 3, 3), ("2024-01-03", 2, 1, 4)]
    other = SeedStore(spark, store.path + "-2", buckets=4, bits=1 << 20)
    other.insert(spark.range(20_000).select(F.col("id").cast("string")))
    store.insert(spark.range(10_000, 30_000).select(F.col("id").cast("string")))
    assert abs(estimated_union(store, other) - 30_004) < 0.03 * 30_004


def test_what_gives_the_ids_runs_once_per_insert(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    store = SeedStore(spark, str(tmp_path / "set"))
    ids = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "id string")
    assert sorted(r.id for r in store.insert(ids.mapInArrow(count, "id string"), name="x", added_on="2024-01-01").collect()) == ["a", "b"]
    assert seen.value == 4
    assert [tuple(r)[1:] for r in store.totals().collect()] == [(3, 2, 2)]
