"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.llm import (chat, decontaminate, extract_html, infill, jaccard, licences, mixing, packing, quality, sharding, sql,
                          suffix_tree, token_files, vector_codes)
from pagelake.llm.common import table
from pagelake.session import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = dict(sql.ORACLE)


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_pack_power_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "bucket")


@query
def op3_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


@query
def op4_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)],
                                  "conv_id long, turn long, role string, text string")
    formatted = chat.format_messages(chat.text_parts(rows.unionByName(extra)))
    return chat.read_back(formatted)


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.write_token_files(table(spark, sf_dir, "documents"), fresh_dir(spark, "tokens"),
                                         tokenizer("word_bpe_49k.json"))
    return token_files.with_crc(token_files.read_token_files(spark, path)) \
        .select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op7_proportional_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "source")


@query
def op5_mcd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


@query
def op10_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op9_cgk_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(table(spark, sf_dir, "documents"), suffix_tree.held_out_fold("doc_id"))


@query
def op8_crf_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_html.extract_main_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = infill.restore(infill.fill_in_middle(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256"))


@query
def op13_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mixing.taken_per_document(mix).select("doc_id", "size", "source_size", "target", "taken")
