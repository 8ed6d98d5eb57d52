"""Token ids as Parquet list columns.

``write_token_files`` range-partitions the documents by id, encodes each range
in order and writes one Parquet file per range.  A row holds the document's
ids as a list column plus its token count and its offset inside the file;
ids are dictionary-encoded (a vocabulary fits one dictionary page), the
numeric columns delta-encoded (format v2 pages without a dictionary), row
groups and pages are kept small and Parquet writes column and offset indexes,
so a reader can take the metadata columns alone, or the pages of a few
documents.  ``read_token_files`` adds each document's global start from the
per-file totals, which are read from the narrow columns only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.tokens import FileEncoder, slices

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000


def encode_in_order(docs: DataFrame, tokenizer: str, end_id: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Range partitions in ascending id order: ``doc_id``, ``part``,
    ``local_start``, ``n_tokens``, ``ids``."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("part", T.IntegerType()),
        T.StructField("local_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def encode(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        enc = FileEncoder.load(tokenizer)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        part, at = TaskContext.get().partitionId(), 0
        for b in slices(batches):
            raw = [enc.encode(t) + end for t in b.column(1).to_pylist()]
            n = np.fromiter((len(r) // 4 for r in raw), dtype=np.int64, count=len(raw))
            offsets = np.concatenate([[0], np.cumsum(n)])
            flat = pa.array(np.frombuffer(b"".join(raw), dtype="<i4"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.full(len(raw), part, dtype=np.int32)), pa.array(at + offsets[:-1]),
                 pa.array(n), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), flat)],
                names=[f.name for f in schema.fields])
            at += int(offsets[-1])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]  # the second splits rows of one id
    ordered = source.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(encode, schema)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2,
                      id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the files under ``path`` (a folder that does not exist yet).

    Null or empty text: the end id alone.  Null ids come first; rows with equal
    ids are documents of their own, in the order of their text's hash.  Other
    columns are ignored.  An empty table writes no rows.
    """
    plain = "parquet.enable.dictionary#"
    writer = encode_in_order(docs, tokenizer, end_id, id_col, text_col).write
    for k, v in {
        "parquet.writer.version": "v2", "parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size": PAGE_BYTES,
        "parquet.page.row.count.limit": PAGE_ROWS, "compression": "zstd",
        f"{plain}doc_id": "false", f"{plain}local_start": "false", f"{plain}n_tokens": "false",
    }.items():
        writer = writer.option(k, v)
    writer.parquet(path)
    return path


def read_token_files(spark: SparkSession, path: str, columns: tuple[str, ...] = ("n_tokens", "ids")) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it) and ``columns``.
    Only the columns asked for are read."""
    files = spark.read.parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    base = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    rows = files.select("doc_id", "part", "local_start", *columns)
    # one row per file written: bounded by the number of files, not by the data
    return rows.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("_base") + F.col("local_start")).alias("start"), *columns)


def with_crc(tokens: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``, the CRC-32 of its little-endian bytes."""
    keep = [f for f in tokens.schema.fields if f.name != "ids"]
    schema = T.StructType([*keep, T.StructField("ids_crc32", T.LongType())])

    def crc(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for b in batches:
            lists = b.column(len(keep))
            at = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            sums = np.fromiter((zlib.crc32(flat[at[i]:at[i + 1]].tobytes()) for i in range(len(lists))),
                               dtype=np.int64, count=len(lists))
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + [pa.array(sums)],
                                             names=[f.name for f in schema.fields])

    return tokens.select(*[f.name for f in keep], "ids").mapInArrow(crc, schema)
