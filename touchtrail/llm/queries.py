"""Registered queries of this package: thin projections over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchtrail.llm import (
    block_anchors,
    conversation_repair,
    decontaminate,
    embedding_collisions,
    interpolation_lm,
    license_scan,
    packing,
    quality_rules,
    secret_ledger,
    simhash,
    suffix_lpf,
    token_counts,
    whitening,
)
from touchtrail.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def packing_tokenizer() -> tuple[str, str, str]:
    import public_tokenizers

    return (
        tokenizer_file("byte_bpe_50k.json"),
        tokenizer_file("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3)
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op3_suffix_lpf(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_lpf.remove_repeats(read_table(spark, sf_dir, "documents"), length=50)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_ledger.scan(read_table(spark, sf_dir, "documents"))
    findings = F.col("findings")

    def of(kind: str):
        return F.size(F.filter(findings, lambda f: f["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(secret_ledger.listed(F.filter(findings, lambda f: f["base"])), 256).alias(
            "base_sha256"
        ),
        secret_ledger.listed(findings).alias("spans"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), limit=2048
    )


def op6_interpolation_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = interpolation_lm.score(read_table(spark, sf_dir, "documents"))
    return scored.drop("train_types")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), packing_tokenizer(), capacity=2048)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_rules.apply_rules(read_table(spark, sf_dir, "documents"), lang_col="lang")
    return scored.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (
            (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
        ).alias("base_failed"),
        "kept",
    )


def op9_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


def op10_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = block_anchors.remove_repeats(read_table(spark, sf_dir, "documents"), window=35)
    return left.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=8)
    return found.withColumn("deviation", F.col("deviation").cast("long"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damaged(rows))


def op13_embedding_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_collisions.near_duplicates(read_table(spark, sf_dir, "embeddings"), least=0.9)


def queries() -> dict[str, Query]:
    return {
        "op1_simhash": op1_simhash,
        "op2_license_scan": op2_license_scan,
        "op3_suffix_lpf": op3_suffix_lpf,
        "op4_secret_ledger": op4_secret_ledger,
        "op5_token_counts": op5_token_counts,
        "op6_interpolation_lm": op6_interpolation_lm,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_quality_rules": op8_quality_rules,
        "op9_bm25_decontamination": op9_bm25_decontamination,
        "op10_block_anchors": op10_block_anchors,
        "op11_whitening": op11_whitening,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_embedding_collisions": op13_embedding_collisions,
    }
