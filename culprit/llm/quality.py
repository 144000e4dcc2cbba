"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from culprit.llm.common import crc_part, first_by_hash, kept_table, texts_of, word_blocks

TRAIN_ROWS = 20_000
TREES, DEPTH, BINS, RATE, RIDGE, LEAST = 80, 4, 32, 0.15, 1.0, 10.0
CUT = 0.7

GROUPS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\v\f\r",
    "line_feed": b"\n",
    "stop": b".",
    "comma": b",",
    "loud": b"!?",
    "mark": b"#$%&*+/<=>@[]^_{|}~\\`",
    "other_punctuation": b"\"'();:-",
    "high": bytes(range(128, 256)),
}
FEATURES = [
    *[f"share_{name}" for name in GROUPS],
    "log_bytes", "log_words", "word_bytes", "unique_words", "top_word", "repeated_neighbour", "long_words",
    "log_lines", "unique_lines", "line_bytes", "letter_entropy",
]


def statistics(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The features of each text, (texts, features); an empty text has zeros."""
    member = np.zeros((256, len(GROUPS)))
    for i, chars in enumerate(GROUPS.values()):
        member[np.frombuffer(chars, np.uint8), i] = 1
    out = np.zeros((len(offsets) - 1, len(FEATURES)))
    wide = len(GROUPS)
    for row, (start, stop) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        if start == stop:
            continue
        counts = np.bincount(data[start:stop], minlength=256)
        size = stop - start
        text = data[start:stop].tobytes()
        tally, neighbours, last = Counter(), 0, None
        for words in word_blocks(text):
            tally.update(words)
            neighbours += sum(map(eq, words, [last, *words]))
            last = words[-1] if words else last
        lines = text.split(b"\n")
        n_words = tally.total()
        n = max(1, n_words)
        share = counts[counts > 0] / size
        out[row, :wide] = counts @ member / size
        out[row, wide:] = (
            np.log1p(size),
            np.log1p(n_words),
            sum(len(w) * m for w, m in tally.items()) / n,
            len(tally) / n,
            max(tally.values(), default=0) / n,
            neighbours / n,
            sum(m for w, m in tally.items() if len(w) > 20) / n,
            np.log1p(len(lines)),
            len(set(lines)) / len(lines),
            size / len(lines) / 1000,
            -(share * np.log2(share)).sum(),
        )
    return out


@dataclass
class Trees:
    """Complete binary trees flattened into arrays: nodes of tree t are rows of ``feature[t]``."""

    feature: np.ndarray  # (trees, 2**depth - 1)
    limit: np.ndarray  # the right child is taken where the value is above the limit
    value: np.ndarray  # (trees, 2**depth): added log-odds per leaf
    base: float

    def score(self, x: np.ndarray, rows: int = 8192) -> np.ndarray:
        """Probability of label 1, walking all trees of a block of rows level by level."""
        depth = int(np.log2(self.value.shape[1]))
        out = np.empty(len(x))
        tree = np.arange(len(self.feature))[None, :]
        for at in range(0, len(x), rows):
            part = x[at : at + rows]
            node = np.zeros((len(part), len(self.feature)), np.int64)
            for _ in range(depth):
                seen = part[np.arange(len(part))[:, None], self.feature[tree, node]]
                node = 2 * node + 1 + (seen > self.limit[tree, node])
            margin = self.base + self.value[tree, node - (2**depth - 1)].sum(axis=1)
            out[at : at + rows] = 1 / (1 + np.exp(-margin))
        return out


def boost(
    x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE, weight: np.ndarray | None = None
) -> Trees:
    """Fit by second-order boosting of the logistic loss on histograms of ``bins`` quantile bins."""
    weight = np.ones(len(y)) if weight is None else weight
    positive = np.clip(np.average(y, weights=weight) if len(y) else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(positive / (1 - positive)))
    nodes, leaves = 2**depth - 1, 2**depth
    model = Trees(np.zeros((trees, nodes), np.int64), np.full((trees, nodes), np.inf), np.zeros((trees, leaves)), base)
    if not len(y):
        return model
    edges = [np.unique(np.quantile(column, np.arange(1, bins) / bins)) for column in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
    margin = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.full(width, 1e-6)
            for f, edge in enumerate(edges):
                cell = local * bins + binned[f]
                g = np.bincount(cell, slope, width * bins).reshape(width, bins).cumsum(axis=1)
                h = np.bincount(cell, curve, width * bins).reshape(width, bins).cumsum(axis=1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all**2 / (h_all + RIDGE)
                gain[(h < LEAST / 4) | (h_all - h < LEAST / 4)] = 0
                at = gain[:, : len(edge)].argmax(axis=1) if len(edge) else np.zeros(width, np.int64)
                top = gain[np.arange(width), at]
                for w in np.flatnonzero((top > best) & (len(edge) > 0)):
                    best[w] = top[w]
                    model.feature[t, first + w], model.limit[t, first + w] = f, edge[at[w]]
            seen = x[np.arange(len(y)), model.feature[t, node]]
            node = 2 * node + 1 + (seen > model.limit[t, node])
        leaf = node - nodes
        g, h = np.bincount(leaf, slope, leaves), np.bincount(leaf, curve, leaves)
        model.value[t] = -rate * g / (h + RIDGE)
        margin += model.value[t][leaf]
    return model


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stats = statistics(*texts_of(batch.column(1)))
        flat = pa.ListArray.from_arrays(np.arange(0, stats.size + 1, stats.shape[1], dtype=np.int32), stats.ravel())
        yield pa.RecordBatch.from_arrays([batch.column(0), flat], ["y", "x"])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS) -> Trees:
    """Train on the ``rows`` labelled documents that come first by a hash of key and text.

    Rows with a null key or label are not used; a document with several labels is used with
    each of them, rows that repeat key, text and label once. Without any labelled row every score is 0.5.
    """
    marks = labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("y")).filter("y IN (0, 1)")
    order = F.xxhash64(F.col(key), F.col(text))
    pairs = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"), order.alias("_h"))
    chosen = docs.select(F.col(key).alias("_key"), order.alias("_h")).join(marks, F.col("_key") == F.col("_id"))
    chosen = kept_table(chosen.select("_key", "_h", "y").distinct(), "labelled")
    chosen = first_by_hash(chosen, "_h", rows).orderBy("_h", "_key", "y").limit(rows)
    picked = pairs.join(F.broadcast(chosen), ["_key", "_h"]).dropDuplicates(["_key", "_h", "y"])
    picked = picked.select("y", F.coalesce("_text", F.lit("")).alias("_text"))
    got = picked.mapInArrow(_feature_rows, "y int, x array<double>").collect()
    got.sort()
    x = np.array([r["x"] for r in got]).reshape(len(got), len(FEATURES))
    return boost(x, np.array([r["y"] for r in got], float))


def predict(docs: DataFrame, model: Trees, text: str = "text", keep: list[str] | None = None, cut: float = CUT) -> DataFrame:
    """All columns (or ``keep``), ``score`` and ``predicted`` (1 where the score reaches ``cut``).

    A null text is scored as an empty one. Added columns replace others of that name.
    """
    keep = [c for c in keep or docs.columns if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField("row", docs.select(*keep).schema), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(statistics(*texts_of(batch.column(1))))
            columns = [batch.column(0), pa.array(scores), pa.array((scores >= cut).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).cast("string"))
    return rows.mapInArrow(score, T.StructType(fields)).select("row.*", "score", "predicted")


def held_out(key: str = "doc_id", parts: int = 4, which: int = 2) -> Column:
    return F.coalesce(crc_part(key, parts) == which, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document.

    Labels are learned from rows whose crc32 is not 2 modulo 4. Repeated rows get equal
    results; a row with a null id is scored and not held out.
    """
    model = fit(docs.filter(crc_part(key, 4) != 2), labels, key, text)
    rows = docs.select(F.col(key).alias("doc_id"), held_out(key).alias("held_out"), F.col(text).alias("_text"))
    return predict(rows, model, "_text", keep=["doc_id", "held_out"])
