"""Table sources and sinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from culprit.fixed_values import LABEL, SIGNALS
from culprit.sources.shared import path_exists

COUNT_SIGNALS = {"oom_log_count", "timeout_log_count"}


def incident_schema(label: str = LABEL, key: str | None = "incident_id") -> T.StructType:
    fields = [T.StructField(key, T.LongType(), True)] if key else []
    for name in SIGNALS:
        kind = T.LongType() if name in COUNT_SIGNALS else T.DoubleType()
        fields.append(T.StructField(name, kind, True))
    fields.append(T.StructField(label, T.StringType(), True))
    return T.StructType(fields)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read CSV (with header) or parquet, chosen by the suffix in any case.

    Pass a schema for CSV when it is known: inferring one costs a pass over the file.
    """
    path = str(path)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix == ".csv":
        reader = spark.read.option("header", True)
        if schema is None:
            return reader.option("inferSchema", True).csv(path)
        return reader.option("enforceSchema", False).schema(schema).csv(path)
    if suffix in (".parquet", ".pq"):
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    raise ValueError(f"cannot read {suffix or 'a path without suffix'}: use .csv, .parquet or .pq")


def write_table(df: DataFrame, path: str) -> str:
    """Write the whole table as CSV (with header) or parquet, chosen by the suffix."""
    path = str(path)
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    writer = df.write.mode("overwrite")
    if suffix == ".csv":
        writer.option("header", True).csv(path)
    elif suffix in (".parquet", ".pq"):
        writer.parquet(path)
    else:
        raise ValueError(f"cannot write {suffix or 'a path without suffix'}: use .csv, .parquet or .pq")
    return path


def write_splits(df: DataFrame, path: str) -> str:
    """Write all splits at once, one directory per split, so a reader prunes to its own."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no splits at {path}")
    return spark.read.parquet(path).filter(F.col("split") == split).drop("split")


def write_document(df: DataFrame, path: str) -> str:
    """Write one JSON document per row; tables of metrics and summaries, a row per model."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)
    return path
