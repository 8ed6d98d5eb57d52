"""Table creation (typed and all-text), appends, and seed counts."""

import tempfile

from pagelake.operators import aggregates as ag
from pagelake.sinks import tables as sk


def test_create_tables_typed_and_text(spark):
    loc = tempfile.mkdtemp(prefix="pl-tables-")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pl_text LOCATION '{loc}/db'")
    status = sk.create_tables(spark, loc + "/text", text_only=True, database="pl_text")
    assert set(status.values()) == {"created"}
    types = {f.dataType.simpleString() for f in spark.table("pl_text.statuses").schema.fields}
    assert types == {"string"}
    again = sk.create_tables(spark, loc + "/text", text_only=True, database="pl_text", tables=["statuses"])
    assert again["statuses"].startswith("failed")  # an existing table is reported, not replaced


def test_append_keeps_copies(spark):
    path = tempfile.mkdtemp(prefix="pl-append-") + "/t"
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    sk.append_table(df, path)
    sk.append_table(df, path)
    assert spark.read.parquet(path).count() == 2


def test_seed_counts_exact_and_approx(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "u long")
    exact = ag.seed_counts(df, "u").collect()[0]
    assert (exact.n_rows, exact.n_ids, exact.n_distinct) == (4, 3, 2)
    assert ag.seed_counts(df, "u", approx=True).collect()[0].n_distinct == 2
