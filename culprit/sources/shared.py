"""The shared folder for intermediate tables."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TASK_ROWS = 12_500  # rows that are worth a task of their own
MOST_TASK_ROWS = 1_000_000  # tables with more rows a core come in many files already


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="culprit-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows spread by key over all cores; a table of few rows stays as it is.

    Wide numeric rows compress so well that a table of a million rows can be one file and one
    task. Where a row costs much work, its bytes say nothing about the tasks it is worth.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    rows = df.count()
    tasks = min(math.ceil(rows / TASK_ROWS), cores)
    return df.repartition(tasks, key) if tasks > 1 and rows <= MOST_TASK_ROWS * cores else df


def small(df: DataFrame) -> DataFrame:
    """A derived table of a few rows per class, written so that joins know its size.

    Spark broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` bytes and else merges,
    with adaptive skew handling. Nothing is fetched to the driver.
    """
    return written(df, "derived")


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under a path, sorted."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())
