"""Cleaning of ``documents`` for training, stage by stage.

Each stage keeps rows whatever their ids, nulls and repeats included, unless its own rule rejects
them, and carries further columns along. An empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import ngram_join, packing, quality_rules, secret_scan, toxicity
from tradewind.llm.queries import tokenizer
from tradewind.llm.text import read, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep(docs)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity."""
    return toxicity.keep(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares most of its word n-grams: the one with the smallest id."""
    return ngram_join.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets blotted out; lengths brought up to date."""
    clean = secret_scan.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.col("n_chars").isNull(), None).otherwise(F.length("text")).cast(kind))
    return clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("toxicity", harmless),
    ("n-gram Jaccard join", distinct),
    ("secret scans", without_secrets),
    ("packing", packed),
]
ORACLE_SQL = None  # a learned stage is no SQL; tests hold the stages against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
