"""Seed inputs: id lists (order matters), status seed files, seed sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.operators.ordinal import add_ordinal
from pagelake.schemas import STATUS_SEEDS


def with_line_order(df: DataFrame) -> DataFrame:
    """Add ``_file`` / ``_block`` / ``_row`` columns that give file line order.

    ``monotonically_increasing_id`` grows within one input split, and splits of
    one file are ordered by their start byte; files are ordered by name.
    """
    return (df.withColumn("_file", F.col("_metadata.file_path"))
              .withColumn("_block", F.col("_metadata.file_block_start"))
              .withColumn("_row", F.monotonically_increasing_id()))


def read_id_list(spark: SparkSession, path: str, name: str = "id") -> DataFrame:
    """Text file(s), one id per line -> ``(ordinal, id)``; ordinal is 0-based
    in file order and counts every line, so position *i* is line *i* also
    after blank lines.  Line ends and surrounding white space are stripped;
    a blank line keeps its position but gives no row."""
    lines = with_line_order(spark.read.text(path))
    lines = lines.select(_stripped("value").alias(name), "_file", "_block", "_row")
    return add_ordinal(lines, ["_file", "_block", "_row"]).drop("_file", "_block", "_row") \
        .select("ordinal", name).where(F.col(name) != "")


def _stripped(column: str) -> Column:
    return F.regexp_replace(F.col(column), r"^\s+|\s+$", "")


def read_lines(spark: SparkSession, path: str, name: str = "id") -> DataFrame:
    """Text file(s), one value per line, where line order does not matter
    (a done list used as a set): no ordinal, so no sort."""
    v = _stripped("value")
    return spark.read.text(path).select(v.alias(name)).where(F.col(name) != "")


def zip_lists(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pair line *i* of one list with line *i* of another (inner: shorter wins)."""
    return a.join(b, "ordinal", "inner")


def read_status_seeds(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines ``{"statues_id": ..., "user_id": ...}``; other fields ignored,
    duplicates kept, ids as text (numbers and strings both)."""
    return spark.read.schema(STATUS_SEEDS).json(path)


def read_seed_set(spark: SparkSession, source: str | DataFrame, column: str = "id",
                  fmt: str = "parquet") -> DataFrame:
    """Distinct ids of a named set, as text.  ``source`` is a table name, a
    path, or a DataFrame."""
    if isinstance(source, DataFrame):
        df = source
    elif "/" in source:
        df = spark.read.format(fmt).load(source)
    else:
        df = spark.read.table(source)
    return df.select(F.col(column).cast("string").alias("id")).where(F.col("id").isNotNull()).distinct()
