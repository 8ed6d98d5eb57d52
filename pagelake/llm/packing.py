"""Packing by power-of-two decomposition.

A document of ``n`` ids is cut into ``n // seq_len`` pieces of ``seq_len`` and
one piece for each set bit of the remainder, longest first.  Every piece is a
sequence of its own whose length is a power of two, so no sequence crosses
documents and none is padded; sequences of equal length share a ``bucket``
(log2 of the length), from which batches of one length are drawn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.tokens import FileEncoder, slices

SEQ_LEN = 2048


def binary_pieces(n: int, seq_len: int = SEQ_LEN) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids, in order."""
    out = [(s, seq_len) for s in range(0, n - n % seq_len, seq_len)]
    at = n - n % seq_len
    for k in range(seq_len.bit_length() - 2, -1, -1):
        if (n % seq_len) >> k & 1:
            out.append((at, 1 << k))
            at += 1 << k
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, seq_len: int = SEQ_LEN,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every row of ``docs``: ``doc_id``, ``start``, ``length``,
    ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``, ``bucket``,
    ``sequence_id``, ``offset`` (always 0: a sequence is one piece).

    ``seq_len`` must be a power of two.  Null or empty text: the end id alone,
    one piece of length 1.  A null id stays null; rows with equal ids are
    documents of their own.  Other columns of ``docs`` are ignored, whatever
    their names.  An empty table gives no rows.  ``sequence_id`` is unique and
    ascends within a partition; it isn't gapless.  One pass, no shuffle.
    """
    if seq_len & (seq_len - 1) or seq_len < 1:
        raise ValueError("seq_len must be a power of two")
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("bucket", T.IntegerType())])

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        enc = FileEncoder.load(tokenizer)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        for b in slices(batches):
            rows, start, length, ids, total = [], [], [], [], []
            for i, raw in enumerate(map(enc.encode, b.column(1).to_pylist())):
                raw += end
                n = len(raw) // 4
                for s, k in binary_pieces(n, seq_len):
                    rows.append(i)
                    start.append(s)
                    length.append(k)
                    ids.append(raw[4 * s:4 * (s + k)])
                    total.append(n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int32())), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(total, pa.int64()),
                 pa.array([k.bit_length() - 1 for k in length], pa.int32())],
                names=[f.name for f in schema.fields])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(cut, schema).select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
