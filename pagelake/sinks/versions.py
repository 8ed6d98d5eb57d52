"""Tables that a stream writes, exactly once.

* ``upsert``: a small table with a key, kept as versioned folders and a pointer
  file.  A batch writes a new version beside the current one and then switches
  the pointer, so a reader always sees a whole version, a run that dies between
  the two leaves the old table, and a repeated batch changes nothing.
* ``append_batch``: an append-only table whose batches are folders named by
  query and batch id.  A batch that is run again replaces its own folder, so a
  restart leaves no second copy; batches are never rewritten otherwise.

Both go through Hadoop's file system, so the folder may be any that Spark can
write.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "_current.json"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pointer(spark: SparkSession, table: str) -> dict | None:
    jvm, path, fs = _hadoop(spark, f"{table.rstrip('/')}/{POINTER}")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _switch(spark: SparkSession, table: str, state: dict) -> None:
    """Replace the pointer in one step: write a new file, rename it over the
    old one."""
    jvm, path, _ = _hadoop(spark, f"{table.rstrip('/')}/{POINTER}")
    _, fresh, fs = _hadoop(spark, f"{table.rstrip('/')}/_next-{uuid.uuid4().hex}.json")
    out = fs.create(fresh, True)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fresh, path, options)


def read_current(spark: SparkSession, table: str) -> DataFrame | None:
    """The current version; None before the first batch."""
    state = _pointer(spark, table)
    return None if state is None else spark.read.parquet(f"{table.rstrip('/')}/{state['version']}")


def upsert(batch: DataFrame, table: str, keys: Sequence[str], query: str, batch_id: int,
           before_switch: Callable[[], None] | None = None) -> bool:
    """Rows of ``batch`` replace those with their key (null is a value; one
    row per key).  False when (``query``, ``batch_id``) or a later batch of the
    query is in the table already.  A cost of one rewrite of the table per
    batch: meant for one row per group, not for records.

    ``before_switch`` runs when the new version is written but not yet current.
    """
    spark = batch.sparkSession
    state = _pointer(spark, table) or {"version": None, "previous": None, "batches": {}}
    if state["batches"].get(query, -1) >= batch_id:
        return False
    rows = batch
    if state["version"]:
        old = spark.read.parquet(f"{table.rstrip('/')}/{state['version']}")
        touched = batch.select(*[F.col(k).alias(f"_up_{i}") for i, k in enumerate(keys)])
        same = F.lit(True)
        for i, k in enumerate(keys):
            same &= F.col(k).eqNullSafe(F.col(f"_up_{i}"))
        rows = old.join(touched, same, "left_anti").unionByName(batch)
    version = f"v-{uuid.uuid4().hex}"
    rows.write.parquet(f"{table.rstrip('/')}/{version}")
    if before_switch:
        before_switch()
    _switch(spark, table, {"version": version, "previous": state["version"], "batches": {**state["batches"], query: batch_id}})
    if state["previous"]:  # the version just replaced stays for readers still at work on it
        _, path, fs = _hadoop(spark, f"{table.rstrip('/')}/{state['previous']}")
        fs.delete(path, True)
    return True


def upsert_sink(table: str, keys: Sequence[str], query: str = "stream") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function of an upserting stream (``outputMode('update')``)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, table, keys, query, batch_id)
    return write


def append_batch(batch: DataFrame, table: str, query: str, batch_id: int, partition_by: str | None = "load_date",
                 ts_col: str = "fetched_at") -> None:
    """Append a batch of a stream exactly once: the folder
    ``query=<query>/batch=<id>`` is written whole or replaced whole.  Records
    inside are kept as they are, copies included; ``partition_by`` is the date
    of ``ts_col``, so that readers prune by date."""
    if "/" in query or "=" in query:
        raise ValueError("a query id is a plain name")
    if partition_by and partition_by not in batch.columns:
        source = F.col(ts_col) if ts_col in batch.columns else F.current_timestamp()
        batch = batch.withColumn(partition_by, F.to_date(source))
    writer = batch.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{table.rstrip('/')}/query={query}/batch={int(batch_id)}")


def append_sink(table: str, query: str = "stream", **options) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function of an appending stream."""
    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, table, query, batch_id, **options)
    return write
