"""The corpus pipeline: quality rules, toxicity, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and
read again as the next stage's docs. All stages but the last return the columns of
documents, with the rows that they keep.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from activity_lake.llm import near_dedup, packing, quality, toxicity
from activity_lake.llm._spark import scratch
from activity_lake.llm.queries import TOKENIZER, toxic_held_out


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's toxicity threshold, by a classifier of the
    labelled ones among them."""
    net = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), toxic_held_out)
    return toxicity.keep_clean(docs, net)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5 words, similarity 0.8)."""
    return near_dedup.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed token sequences: doc_id, start, length, ids, doc_tokens,
    sequence_id, offset, begins, ends."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER)).withColumnRenamed("id", "doc_id")


STAGES = [("quality_rules", quality_rules), ("toxicity", toxicity_filter),
          ("near_duplicates", near_duplicates), ("packing", pack)]

#: The classifier, the sketches and the tokenizer aren't SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
