"""Aggregations: all hash aggregates with map-side partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_commenters(comments: DataFrame) -> DataFrame:
    """The set of commenter ids."""
    return (comments.select(F.col("comment_people_id").alias("user_id"))
            .where(F.col("user_id").isNotNull()).distinct())


def seed_counts(df: DataFrame, column: str, approx: bool = False) -> DataFrame:
    """List size and set size of a seed column (``approx`` for dashboards)."""
    distinct = (F.approx_count_distinct(column) if approx else F.count_distinct(column)).alias("n_distinct")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(column).alias("n_ids"), distinct)


def max_id_mark(statuses: DataFrame, by: Sequence[str] = (), column: str = "user_id") -> DataFrame:
    """Highest numeric id seen so far (the progress mark), per group."""
    v = F.col(column).try_cast("bigint")
    if by:
        return statuses.groupBy(*by).agg(F.max(v).alias("max_id"))
    return statuses.agg(F.max(v).alias("max_id"))


def statuses_per_user(statuses: DataFrame) -> DataFrame:
    """Posts emitted per account."""
    return statuses.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_statuses"))
