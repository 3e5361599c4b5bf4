"""Queries over the given tables: each applies one operator to its whole table and
derives the digest columns from the operator's result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, best_fit, bpe, chat, divergence, lm_scoring, near_dedup, packing, quality, sharding, topk_search,
               toxicity, url_filter)
from ._spark import text_bytes

#: Fixed values of the contracts.
SHARDS = 24
TOKENIZER = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str, modulus: int, remainder: int):
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def lm_held_out(column: str):
    return id_remainder(column, 7, 2)


def toxic_held_out(column: str):
    return id_remainder(column, 4, 2)


def op1_shard_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    text = F.coalesce(text_bytes(docs, "text"), F.lit("").cast("binary"))
    rows = docs.select("doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = sharding.interleave(rows, SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES).withColumnRenamed("id", "page_id")


def op3_lm_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(_table(spark, sf_dir, "documents"), lm_held_out).withColumnRenamed("id", "doc_id")


def op4_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    net = toxicity.train(docs, _table(spark, sf_dir, "labels"), toxic_held_out)
    out = toxicity.score(docs, net).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", toxic_held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "lang_threshold", "toxic")


def op5_topk_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"), 5)


def op6_pack_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return out.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset", "begins", "ends")


def op7_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def op8_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(_table(spark, sf_dir, "documents"))
    base = (F.col("n_words") < quality.MIN_WORDS) | (100 * F.col("n_repeat_words") > quality.MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base.alias("base_failed"), "kept")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), digests=True)
    return out.withColumnRenamed("id", "doc_id")


def op10_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(_table(spark, sf_dir, "conversations")).select(
        F.col("conv").alias("conv_id"), F.col("n_turns").cast("long").alias("n_turns"), "n_copies", "text")


def op11_bulk_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = best_fit.pack_best_fit(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return out.select(F.col("id").alias("doc_id"), "piece", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                      F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op12_align_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = alignment.align(_table(spark, sf_dir, "documents"), *map(public_tokenizers.path, ALIGNED))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return out.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_shard_interleave, op2_url_filter, op3_lm_bloom, op4_toxicity_cnn, op5_topk_tiles, op6_pack_concat,
    op7_setsketch_dedup, op8_quality_cascade, op9_bpe, op10_chat_collapse,
    op11_bulk_best_fit, op12_align_cuts, op13_source_divergence)}

ORACLE = {
    "op1_shard_interleave": sharding.ORACLE_SQL,
    "op2_url_filter": url_filter.ORACLE_SQL,
    "op5_topk_tiles": topk_search.ORACLE_SQL,
    "op7_setsketch_dedup": near_dedup.ORACLE_SQL,
    "op8_quality_cascade": quality.ORACLE_SQL,
    "op10_chat_collapse": chat.ORACLE_SQL,
    "op13_source_divergence": divergence.ORACLE_SQL,
}
