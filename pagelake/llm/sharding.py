"""Sharding by proportional stratified interleaving.

Within each source the rows are shuffled by a seeded hash and ranked; rank
``r`` (from 1) of ``n`` has the fractional rank ``(r - 1/2) / n``.  All rows
sorted by fractional rank mix the sources in proportion everywhere, so cutting
that order into equal runs gives shards whose mixture is the corpus's and
whose row counts are at most one apart.

Both orders are range partitions with carried-in counts, so a source that
holds a third of all rows is spread over many tasks.  Only keys travel; the
text is reduced to its size and checksum in the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.operators.ordinal import add_ordinal, keyed_running_count

SHARDS = 40
SEED = 20_240_607


def interleave(rows: DataFrame, stratum: Column, key: Column, ties: Sequence[str],
               shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long, gapless from 0 in its shard).

    ``stratum``: the source (null is a stratum of its own).  ``key``: what the
    seeded shuffle hashes; ``ties`` are columns of ``rows`` that order equal
    hashes, so only rows equal in all of them are interchangeable.  With fewer
    rows than shards the last shards stay empty.  Columns of ``rows`` must not
    start with ``_il_``.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    keyed = rows.withColumns({
        "_il_s": F.coalesce(F.concat(F.lit("="), stratum.cast("string")), F.lit("null")),
        "_il_h": F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null"))))})
    order = ["_il_h", *ties]
    ranked = keyed_running_count(keyed, ["_il_s"], order, name="_il_r")
    sizes = ranked.groupBy("_il_s").agg(F.count(F.lit(1)).alias("_il_n"))
    mixed = ranked.join(sizes, "_il_s").withColumn(
        "_il_f", (2 * F.col("_il_r") - 1).cast("double") / (2 * F.col("_il_n")).cast("double"))
    placed = add_ordinal(mixed, ["_il_f", "_il_s", *order], "_il_p", length="_il_t")
    shard = F.expr(f"_il_p * {shards} div _il_t")
    first = F.expr(f"((_il_p * {shards} div _il_t) * _il_t + {shards - 1}) div {shards}")
    return placed.withColumns({"shard": shard.cast("int"), "slot": (F.col("_il_p") - first).cast("long")}) \
        .drop("_il_s", "_il_h", "_il_r", "_il_n", "_il_f", "_il_p", "_il_t")


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Shards of documents: ``doc_id``, ``source``, ``size`` (UTF-8 bytes of
    the text, null: none, plus 16), ``text_crc32``, ``shard``, ``slot``.

    Null text counts as empty; a null source is a stratum; null ids and rows
    repeated in full are placed like any other.  Other columns are ignored.
    An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    light = docs.select("doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"),
                        F.crc32(text).cast("long").alias("text_crc32"))
    return interleave(light, F.col("source"), F.col("doc_id"), ["doc_id", "text_crc32", "size"], shards, seed)
