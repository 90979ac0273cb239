"""The registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import bpe, compression_quality, conversation_repair, divergence, embedding_dedup, katz, license_scan, ngram_join, packing, quality_rules, secret_scan, sharding, toxicity
from tradewind.llm.text import read, remainder


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_texts(read(spark, sf_dir, "documents"))


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"), source="source")
    return found.select("doc_id", "source", "start", "end", "candidate", F.round("score", 6).alias("score"), "secret")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scores = toxicity.score(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")))
    return scores.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), decoded=True)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(read(spark, sf_dir, "documents")).drop("rejected_by")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.classes(read(spark, sf_dir, "embeddings"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents")).drop("spans")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = [f"shard-{i:04d}" for i in range(256)]
    return sharding.place(read(spark, sf_dir, "documents"), shards).withColumnRenamed("key", "doc_id")


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audit(read(spark, sf_dir, "conversations"))


def op13_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.score_texts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_katz_backoff": op1_katz_backoff,
    "op2_harmonic_packing": op2_harmonic_packing,
    "op3_secret_scan": op3_secret_scan,
    "op4_toxicity": op4_toxicity,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_quality_cascade": op6_quality_cascade,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_ngram_join": op9_ngram_join,
    "op10_sharding": op10_sharding,
    "op11_divergence_audit": op11_divergence_audit,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_compression_quality": op13_compression_quality,
}
