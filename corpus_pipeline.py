"""A training-data pipeline over ``documents``: quality, repeated lines, near-duplicates, benchmark leaks, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.llm import decontam, line_dedup, near_copies, packing, quality
from beaconry.llm.support import staged


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at 0.3 or more; it learns from the labels of what it is given."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the later occurrences of repeated runs of lines; documents that have no line left go."""
    return line_dedup.strip_repeats(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share five-word shingles at a Jaccard similarity of 0.8 or more, the one with the smallest id."""
    return near_copies.one_of_each(docs, width=5, least=0.8)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths, none across documents."""
    found = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, most=4096)
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", good_documents),
    ("lines", without_repeated_lines),
    ("near_copies", one_of_near_copies),
    ("benchmark", without_leaks),
    ("packing", packed),
]

# The classifier, the fingerprints, the latent search and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
