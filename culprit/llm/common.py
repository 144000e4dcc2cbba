"""Helpers shared by the operators: text buffers, token runs, running sums, connected components."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from culprit.sources.shared import fresh_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A well-spread bijection of 64-bit numbers, another for each salt."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def crc_part(key: str, parts: int) -> Column:
    """crc32 of the key written as text, modulo ``parts``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back; lost executors cost no recomputation."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and UTF-8 bytes of a string column, without copying; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    where = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return where, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def word_blocks(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in lists of about ``size`` bytes, so that a long text stays small."""
    at = 0
    while at < len(text):
        stop = at + size
        if stop < len(text):
            gap = SPACE.search(text, stop)
            stop = gap.start() if gap else len(text)
        yield text[at:stop].split()
        at = stop


def running_total(
    df: DataFrame, groups: list[str], order: Column, ties: list[str], value: str, name: str, pieces: int
) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of each group (0 for the first row).

    ``order`` is a 32-bit number spread evenly, such as a hash. A group is summed in
    ``pieces`` ranges of it, so that one holding most of the rows is still spread over tasks.
    """
    piece = F.floor(order / F.lit(2.0**32 / pieces)).cast("int")
    df = df.withColumns({"_order": order, "_piece": piece})
    keys = [*groups, "_piece"]
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(*groups).orderBy("_piece")) - F.col("_sum")
    sums = sums.select(*[F.col(g).alias(f"_{g}") for g in groups], F.col("_piece").alias("_p"), before.alias("_before"))
    inside = Window.partitionBy(*keys).orderBy("_order", *ties)
    df = df.withColumn(name, F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(value))
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups]
    on = F.col("_piece") == F.col("_p")
    for condition in same:
        on = on & condition
    out = df.join(sums, on, "left").withColumn(name, F.col(name) + F.col("_before"))
    return out.drop("_order", "_piece", "_p", "_before", *[f"_{g}" for g in groups])


def first_by_hash(df: DataFrame, column: str, rows: int) -> DataFrame:
    """The rows whose 64-bit hash ``column`` is below the limit that about ``rows`` rows reach.

    The limit follows from the number of rows and lies six deviations above, so that sorting
    and limiting what is left gives the first ``rows`` and no partition sends many more.
    """
    share = (rows + 6 * math.sqrt(rows)) / max(1, df.count())
    return df.filter(F.col(column) <= min((1 << 63) - 1, int(min(1.0, share) * 2.0**64) - (1 << 63)))


def pieces_for(rows: int, each: int = 1_000) -> int:
    """A power of two of ranges so that each holds about ``each`` rows."""
    return 1 << max(0, math.ceil(math.log2(max(1, rows) / each)))


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the components of the pairs (a, b) in place; labels are the smallest member."""
    while len(a):
        x, y = label[a], label[b]
        keep = x != y
        a, b, x, y = a[keep], b[keep], x[keep], y[keep]
        if not len(a):
            break
        low = np.minimum(x, y)
        np.minimum.at(label, np.maximum(x, y), low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up
    return label


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``comp`` (its smallest reachable node) for every node of edges ``a``, ``b``.

    Every round each label takes the neighbour of least priority, edges are renamed and
    repeats dropped. The first priority is the label itself, which settles stars at once;
    later ones are hashes, which shrink long chains by a constant share. No neighbourhood
    is gathered: a hub is a minimum, summed before the shuffle, and a skewed join.
    """
    least, most = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = kept_table(edges.select(least, most).filter("a <> b").distinct(), "edges")
    labels, turn = None, 0
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = (lambda c: F.col(c)) if turn == 0 else (lambda c, t=turn: F.xxhash64(F.col(c), F.lit(t)))
        best = both.groupBy("a").agg(F.min_by("b", rank("b")).alias("p"))
        parent = best.select("a", F.when(rank("p") < rank("a"), F.col("p")).otherwise(F.col("a")).alias("p"))
        parent = kept_table(parent, "parents")
        if labels is None:
            labels = parent.select(F.col("a").alias("node"), F.col("p").alias("label"))
        else:
            labels = labels.join(parent, F.col("label") == F.col("a"), "left")
            labels = labels.select("node", F.coalesce("p", "label").alias("label"))
        labels = kept_table(labels, "labels")
        for end in ("a", "b"):
            named = parent.select(F.col("a").alias("_end"), F.col("p"))
            edges = edges.join(named, F.col(end) == F.col("_end")).drop(end, "_end").withColumnRenamed("p", end)
        edges = kept_table(edges.select(least, most).filter("a <> b").distinct(), "edges")
        turn += 1
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("comp"))
    smallest = kept_table(labels.groupBy("label").agg(F.min("node").alias("comp")), "smallest")
    return labels.join(smallest, "label").select("node", "comp")
