"""Sinks.

Appends go to Parquet tables (typed, so scans get statistics and pushdown);
the all-text relational form of the original sink is ``as_text``.  A re-run
appends again: there is no key, as in the original; ``dedupe_latest`` is the
read-side answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.schemas import SILVER, TABLE_TAGS, as_text, ddl


def write_jsonl(records: dict[str, DataFrame], path: str, mode: str = "overwrite") -> dict[str, str]:
    """One JSON-lines folder per record kind; non-ASCII text is written as is
    (Spark's JSON writer does not escape it)."""
    out = {}
    for kind, df in records.items():
        target = f"{path.rstrip('/')}/{kind}"
        df.write.mode(mode).option("encoding", "UTF-8").json(target)
        out[kind] = target
    return out


def append_table(df: DataFrame, path: str, partition_by: str | None = "load_date",
                 ts_col: str = "fetched_at", fmt: str = "parquet") -> None:
    """Append every declared column to a table folder, partitioned by the
    load date so later reads prune by date."""
    if partition_by and partition_by not in df.columns:
        src = F.col(ts_col) if ts_col in df.columns else F.current_timestamp()
        df = df.withColumn(partition_by, F.to_date(src))
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.save(path)


def create_tables(spark: SparkSession, location: str, text_only: bool = False,
                  tables: list[str] | None = None, database: str | None = None) -> dict[str, str]:
    """Create empty tables for the record kinds (typed, or all text).  A
    table that already exists is left as it is and reported."""
    status = {}
    for name in tables or list(SILVER):
        schema = as_text(SILVER[name]) if text_only else SILVER[name]
        full = f"{database}.{name}" if database else name
        try:
            spark.sql(f"CREATE TABLE {full} ({ddl(schema)}) USING parquet "
                      f"LOCATION '{location.rstrip('/')}/{name}'")
            status[name] = "created"
        except Exception as err:  # noqa: BLE001 - one failed create must not stop the others
            status[name] = f"failed: {type(err).__name__}"
    return status


def write_rejects(rejects: DataFrame, path: str) -> None:
    """Failed rows kept apart; a failure never stops the run."""
    append_table(rejects.withColumn("load_date", F.current_date()), path, partition_by="load_date")


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "append", batch_size: int = 10000) -> None:
    """Spark's own JDBC writer (batched inserts per partition).  The table is
    named by the record tag (``TABLE_TAGS``) in the original layout."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    df.write.mode(mode).jdbc(url, table, properties=props)


def tag_table_name(kind: str) -> str:
    return TABLE_TAGS[kind]


def text_columns(df: DataFrame) -> DataFrame:
    """Every column cast to text (the relational all-``TEXT`` form)."""
    return df.select(*[F.col(f.name).cast(T.StringType()).alias(f.name) for f in df.schema.fields])
