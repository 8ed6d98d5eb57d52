"""Registry of named queries: each is ``(spark, sf_dir) -> DataFrame`` with an
optional DuckDB SQL text that computes the same answer straight from the base
tables (it shares no code with the Spark side)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.session import pin_utc

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            return ntz(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def ntz(df: DataFrame) -> DataFrame:
    """Instants as UTC wall time (``TIMESTAMP_NTZ``), like the base tables."""
    cols = [F.col(f.name).cast(T.TimestampNTZType()).alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)
