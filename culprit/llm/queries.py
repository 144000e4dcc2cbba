"""Queries of the training-data operators over the given tables, and their SQL texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from culprit.llm import (
    decontaminate,
    embedding_dedup,
    language_id,
    line_dedup,
    lm_scoring,
    mixture,
    packing,
    pii,
    quality,
    secrets,
    simhash,
    spelling,
    whitening,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(table(spark, folder, "documents"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, folder, "documents"))
    return out.select("doc_id", "fingerprint", "component_id")


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = line_dedup.remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "text", "n_chunks", "n_removed")


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(table(spark, folder, "documents"))


def op8_mixture(spark: SparkSession, folder: str) -> DataFrame:
    _, shares = mixture.mix(table(spark, folder, "documents"))
    return shares.select("doc_id", "size", "source_size", "target", "taken")


def op9_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score(table(spark, folder, "documents"))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))[0]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_secrets": op2_secrets,
        "op3_simhash": op3_simhash,
        "op4_decontaminate": op4_decontaminate,
        "op5_line_dedup": op5_line_dedup,
        "op6_quality": op6_quality,
        "op7_pii": op7_pii,
        "op8_mixture": op8_mixture,
        "op9_embedding_dedup": op9_embedding_dedup,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_spelling": op11_spelling,
        "op12_packing": op12_packing,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_line_dedup": line_dedup.ORACLE_SQL,
        "op8_mixture": mixture.ORACLE_SQL,
        "op9_embedding_dedup": embedding_dedup.ORACLE_SQL,
        "op11_spelling": spelling.ORACLE_SQL,
    }
