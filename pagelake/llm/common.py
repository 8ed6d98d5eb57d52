"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.session import fresh_dir, work_dir

# The white space that separates words, and the upper-case letters that are folded.
WORD_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared work folder and read it back:
    later actions start from the files, so a lost executor re-reads them
    instead of repeating (or changing) the work above."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables, by name, whose files go when nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        self.paths[name] = path = fresh_dir(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Tables for the steps inside, deleted at the end: no lazy result may read them."""
    tables = Scratch(spark)
    try:
        yield tables
    finally:
        tables.drop(*list(tables.paths))


def checkpointed(df: DataFrame) -> DataFrame:
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as
    UTF-8 (``bytes.lower`` and ``bytes.split`` know ASCII only, which is
    exactly that rule)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def salt(key: str, n: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int")
