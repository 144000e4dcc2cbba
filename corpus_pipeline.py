"""The training-data pipeline over documents: five stages, each an operator of ``culprit.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its rows
are written as Parquet to the shared checkpoint folder and read again by the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culprit.llm import decontaminate, line_dedup, mixture, quality, simhash
from culprit.llm.common import kept_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from their labels, does not reject."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.predict(docs, model).filter("predicted = 1").select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without globally repeated chunks; ``n_chars``, where present, follows the text."""
    out = line_dedup.remove_repeats(docs).select(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies by ``op3``: three-word shingles, three bits."""
    return simhash.one_per_group(docs, words=simhash.WORDS, budget=simhash.BUDGET)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark question."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's share in the mixture of all that were kept."""
    _, shares = mixture.mix(docs)
    return shares


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", remove_near_copies),
    ("decontamination", remove_benchmark),
    ("mixture", mix_sources),
]

# The classifier and the fingerprints have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
