"""Corpus pipeline: quality rules, near-duplicate removal, benchmark
decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``docs``.

Null, empty and blank texts fail the quality rules.  Null ids, languages and
sources are values of their own; rows with equal ids are documents of their
own; of rows repeated in full one stays after the second stage.  Extra columns
are kept, whatever their names: the stages name their helper columns so that
they can't clash.  An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.llm import decontaminate, jaccard, packing, quality
from pagelake.session import fresh_dir

NEAR_WORDS = 5
NEAR_PERCENT = 80
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# The stages up to packing have no SQL form (hash-based search, iterated components and token ids).
ORACLE_SQL = None


def _free(docs: DataFrame, name: str) -> str:
    """``name`` with as many underscores in front as make it new in ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a 64-bit hash of what decides about a row, and its name."""
    row = _free(docs, "_row")
    return docs.withColumn(row, F.xxhash64("doc_id", "text", "lang", "source")), row


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed, row = _keyed(docs)
    verdict = quality.quality_rules(keyed.select("doc_id", "text", "lang", "source", row), keep=(row,))
    return keyed.join(verdict.where("NOT kept").select(row).distinct(), row, "left_anti").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest (doc_id, row hash) of each component stays."""
    keyed, row = _keyed(docs)
    first, copies = _free(docs, "_first"), _free(docs, "_copies")
    # the id carries the row's hash, so one row of several with equal ids can be told
    named = keyed.select(F.struct(F.col("doc_id"), F.col(row).alias("_row")).alias("doc_id"), "text")
    found = jaccard.jaccard_components(named, words=NEAR_WORDS, link=NEAR_PERCENT)
    found = found.select(F.col("doc_id._row").alias(row), (F.col("doc_id") == F.col("component_id")).alias(first))
    rows = found.groupBy(row).agg(F.max(first).alias(first), F.count(F.lit(1)).alias(copies))
    rows = rows.where(~F.col(first) | (F.col(copies) > 1))
    marked = keyed.join(rows, row, "left")
    single = marked.where(F.col(first).isNull()).select(*docs.columns)
    repeated = marked.where(first).dropDuplicates([row]).select(*docs.columns)
    return single.union(repeated)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, TOKENIZER).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared
    work folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
