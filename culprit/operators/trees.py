"""Trees as tables, and Shapley values of tree models that follow the trees' own paths.

A node table has one row per node: ``tree, node, feature, threshold, left, right, cover,
value``. Node 0 is the root; a row goes left where its feature is at most the threshold, a
null one right; a leaf has feature -1 and adds ``value`` (one number per class) to the score.
``cover`` is the weight of the training rows that came by.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culprit import fixed_values as V
from culprit.operators.scoring import predicted_class
from culprit.sources.shared import fresh_path, written

NODES = "tree int, node int, feature int, threshold double, left int, right int, cover double, value array<double>"
PATHS = "tree int, leaf int, value array<double>, low array<double>, high array<double>, share array<double>"
TURN_BYTES = 64 << 20  # leaf paths sent to the tasks at a time
BLOCK_PAIRS = 1 << 16  # (row, leaf) pairs worked on at a time
MOST_PATTERNS = 1 << 10  # ways to agree with a path that are worked out ahead of the rows
LARGEST = float(np.finfo(np.float64).max)


def forest_nodes(spark: SparkSession, head) -> DataFrame:
    """Node table of a fitted MLlib forest, read from its saved form.

    The value of a leaf is its class shares over the number of trees, so that the values of a
    row's leaves add up to the forest's probabilities.
    """
    path = fresh_path(spark, "forest")
    head.write().overwrite().save(path)
    at = F.col("nodeData")
    stats = at["impurityStats"]
    total = F.aggregate(stats, F.lit(0.0), lambda a, v: a + v)
    share = F.transform(stats, lambda v: v / total / F.lit(float(head.getNumTrees)))
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        at["id"].alias("node"),
        at["split"]["featureIndex"].alias("feature"),
        F.get(at["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        at["leftChild"].alias("left"),
        at["rightChild"].alias("right"),
        total.alias("cover"),
        share.alias("value"),
    )


def _paths_of_tree(n_features: int):
    def walk(nodes: pd.DataFrame) -> pd.DataFrame:
        """Every leaf with the bounds of its path per feature and the share of cover that passes them."""
        at = nodes.set_index("node")
        feature, threshold, left, right, cover = (at[c].to_dict() for c in ("feature", "threshold", "left", "right", "cover"))
        out = []
        whole = np.full(n_features, -np.inf), np.full(n_features, np.inf), np.ones(n_features)
        todo = [(0, *whole)]
        while todo:
            node, low, high, share = todo.pop()
            f = feature[node]
            if f < 0:
                out.append((nodes["tree"].iat[0], node, at.at[node, "value"], low, high, share))
                continue
            for child, side in ((left[node], 0), (right[node], 1)):
                bounds = low.copy(), high.copy()
                if side:
                    bounds[0][f] = max(low[f], threshold[node])
                else:
                    bounds[1][f] = min(high[f], threshold[node])
                passed = share.copy()
                passed[f] *= cover[child] / cover[node] if cover[node] else 0.0
                todo.append((child, *bounds, passed))
        return pd.DataFrame(out, columns=["tree", "leaf", "value", "low", "high", "share"])

    return walk


def leaf_paths(nodes: DataFrame, n_features: int) -> DataFrame:
    """``tree, leaf, value, low, high, share``: one row per leaf, three numbers per feature.

    A row's feature agrees with the path where it lies above ``low`` and not above ``high``;
    ``share`` is the part of the cover that does, over all splits of the path on the feature
    (1 where there is none). A tree is walked in one task, trees side by side.
    """
    return nodes.groupBy("tree").applyInPandas(_paths_of_tree(n_features), PATHS)


class LeafSet:
    """Leaf paths as arrays, and the contributions they make."""

    def __init__(self, paths: pd.DataFrame):
        self.low, self.high, self.share, self.value = (np.stack(paths[c].to_list()) for c in ("low", "high", "share", "value"))
        most = int(((self.share != 1) | np.isfinite(self.low) | np.isfinite(self.high)).sum(axis=1).max())
        x, w = np.polynomial.legendre.leggauss(max(1, math.ceil(most / 2)))
        self.u, self.w = (x + 1) / 2, w / 2

    def base(self) -> np.ndarray:
        """Mean score per class of rows spread as the cover is."""
        return self.share.prod(axis=1) @ self.value

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """Shapley values (row, class, feature) of the leaves' summed values.

        With o 1 where a row agrees with a path's feature and 0 elsewhere, and z the feature's
        share, a leaf gives feature i its value times (o_i - z_i) times the mean over u in
        [0, 1] of the product of o_j u + z_j (1 - u) over the other features j. That is a
        polynomial in u, so a Gauss-Legendre sum of half its degree is exact. A row counts by the
        features it agrees on alone: with few features and many rows, all these patterns are
        worked out per leaf, and rows look theirs up.
        """
        if 2 ** x.shape[1] <= min(MOST_PATTERNS, len(x) / 2):
            return self._by_pattern(x)
        n, f = x.shape
        k = self.value.shape[1]
        x = np.maximum(np.where(np.isnan(x), np.inf, x), -LARGEST)
        out = np.zeros((n, f, k))
        rows = min(n, 256) or 1
        step = max(1, BLOCK_PAIRS // rows)
        for at in range(0, len(self.low), step):
            part = slice(at, at + step)
            share = self.share[part]
            without = share[:, :, None] * (1 - self.u)
            with_it = without + self.u
            floor = np.log(np.maximum(without, 1e-300))
            gain = np.log(with_it) - floor
            start = floor.sum(axis=1)[:, None, :]
            agrees = ((1 - share)[:, :, None] / with_it).transpose(0, 2, 1)
            for top in range(0, n, rows):
                some = x[None, top : top + rows]
                hot = (some > self.low[part][:, None]) & (some <= self.high[part][:, None])
                mass = np.exp(np.matmul(hot.astype(np.float64), gain) + start) * self.w
                cold = -(mass @ (1 / (1 - self.u)))
                phi = np.where(hot, np.matmul(mass, agrees), cold[:, :, None])
                size = some.shape[1]
                out[top : top + rows] += (phi.reshape(len(share), size * f).T @ self.value[part]).reshape(size, f, k)
        return out.transpose(0, 2, 1)

    def _by_pattern(self, x: np.ndarray) -> np.ndarray:
        """The same sums, from a table of every leaf's values per pattern of agreeing features."""
        n, f = x.shape
        columns = np.ascontiguousarray(np.maximum(np.where(np.isnan(x), np.inf, x), -LARGEST).T)
        patterns = (np.arange(2**f)[:, None] >> np.arange(f) & 1).astype(bool)
        out = np.zeros((n, f, self.value.shape[1]))
        rows = min(n, 1024)
        step = max(1, BLOCK_PAIRS // rows)
        for at in range(0, len(self.low), step):
            part = slice(at, at + step)
            low, high, share = self.low[part], self.high[part], self.share[part]
            without = share[:, :, None] * (1 - self.u)
            with_it = without + self.u
            floor = np.log(np.maximum(without, 1e-300))
            gain = np.log(with_it) - floor
            mass = np.exp(np.matmul(patterns.astype(np.float64), gain) + floor.sum(axis=1)[:, None, :]) * self.w
            agrees = ((1 - share)[:, :, None] / with_it).transpose(0, 2, 1)
            cold = -(mass @ (1 / (1 - self.u)))
            table = np.where(patterns, np.matmul(mass, agrees), cold[:, :, None]).reshape(-1, f)
            first = (np.arange(len(share)) << f)[:, None]
            for top in range(0, n, rows):
                some = columns[:, top : top + rows]
                place = np.repeat(first, some.shape[1], axis=1)
                for j in range(f):
                    # Most paths leave most features free: every row agrees with those.
                    place += 1 << j
                    bound = np.flatnonzero(np.isfinite(low[:, j]) | np.isfinite(high[:, j]))
                    apart = (some[j] <= low[bound, j, None]) | (some[j] > high[bound, j, None])
                    place[bound] -= apart.astype(np.int64) << j
                phi = table[place]
                size = some.shape[1]
                out[top : top + rows] += (phi.reshape(len(share), size * f).T @ self.value[part]).reshape(size, f, -1)
        return out.transpose(0, 2, 1)


def tree_shap(nodes: DataFrame, scored: DataFrame, features: list[str], n_classes: int, start: list[float] | None = None, turn_bytes: int = TURN_BYTES) -> DataFrame:
    """Add ``phi`` (class x feature) and ``base`` (class): path-dependent Shapley values.

    The value of a feature subset is the score expected when the other features follow the
    cover of the trees' nodes; no background rows are needed. ``start`` is a constant part of
    the score. Leaves go to the tasks in turns of at most ``turn_bytes``; every turn adds its
    part to the rows, which are written in between.

    The rows keep their other columns, which must not be named ``phi`` or ``base``.
    """
    spark = scored.sparkSession
    m = len(features)
    paths = written(leaf_paths(nodes, m), "leaf-paths")
    turns = max(1, math.ceil(paths.count() * 8 * (3 * m + n_classes) / turn_bytes))
    rows = scored.withColumns({"phi": F.lit([[0.0] * m] * n_classes).cast("array<array<double>>"), "base": F.lit([float(b) for b in start or [0.0] * n_classes]).cast("array<double>")})
    names, schema = rows.columns, rows.schema

    def adder(leaves):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            base = leaves.value.base()
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = np.stack([batch.column(f).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in features], axis=1)
                phi = leaves.value.contributions(x) + np.array(batch.column("phi").to_pylist())
                columns = dict(zip(names, batch.columns))
                flat = pa.array(phi.ravel())
                inner = pa.ListArray.from_arrays(pa.array(np.arange(0, phi.size + 1, m), pa.int32()), flat)
                columns["phi"] = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * n_classes + 1, n_classes), pa.int32()), inner)
                columns["base"] = pa.array((np.array(batch.column("base").to_pylist()) + base).tolist())
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

        return add

    turn = F.pmod(F.xxhash64("tree", "leaf"), F.lit(turns))
    for t in range(turns):
        some = paths.filter(turn == t).toPandas()
        if not len(some):
            continue
        rows = rows.mapInArrow(adder(spark.sparkContext.broadcast(LeafSet(some))), schema)
        if t < turns - 1:
            rows = written(rows, "contributions")
    return rows


class CountedForest:
    """A forest with given splits whose covers and class shares are counted from a table.

    It scores in plain column expressions, so that its scores and explanations can be checked
    without fitting. ``splits`` has one dictionary per tree: node -> (feature, threshold,
    left, right); nodes that are not in it are leaves.
    """

    kind = "tree"

    def __init__(self, name: str, classes: list[str], features: list[str], splits: list[dict], counts: dict[tuple[int, int], list[int]]):
        self.name, self.classes, self.features = name, list(classes), list(features)
        self.splits, self.counts = splits, counts

    @classmethod
    def counted(cls, df: DataFrame, splits: list[dict] = V.FOREST, features: list[str] = V.SIGNALS, label: str = V.LABEL, name: str = "Fixed forest") -> CountedForest:
        """Count the rows of every class in every leaf, in one aggregate; null labels do not count."""
        leaves = F.array(*[F.expr(leaf_of(tree)).alias("leaf") for tree in splits])
        rows = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("class"), F.posexplode(leaves).alias("tree", "leaf"))
        found = rows.groupBy("tree", "leaf", "class").agg(F.count("*").alias("n")).collect()
        classes = sorted({r["class"] for r in found})
        place = {c: i for i, c in enumerate(classes)}
        counts: dict[tuple[int, int], list[int]] = {}
        for r in found:
            counts.setdefault((r["tree"], r["leaf"]), [0] * len(classes))[place[r["class"]]] = r["n"]
        return cls(name, classes, features, splits, counts)

    def shares(self, tree: int, leaf: int) -> list[float]:
        """Class shares of a leaf; even ones where no row came by."""
        counts = self.counts.get((tree, leaf), [])
        total = sum(counts)
        return [c / total for c in counts] if total else [1.0 / len(self.classes)] * len(self.classes)

    def rows(self) -> list[tuple]:
        out = []

        def add(tree: int, node: int) -> float:
            split = self.splits[tree].get(node)
            if split is None:
                cover = float(sum(self.counts.get((tree, node), [])))
                value = [s / len(self.splits) for s in self.shares(tree, node)]
                out.append((tree, node, -1, 0.0, -1, -1, cover, value))
            else:
                feature, threshold, left, right = split
                cover = add(tree, left) + add(tree, right)
                out.append((tree, node, self.features.index(feature), float(threshold), left, right, cover, []))
            return cover

        for tree in range(len(self.splits)):
            add(tree, 0)
        return out

    def node_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), NODES)

    def with_scores(self, df: DataFrame) -> DataFrame:
        """Add ``proba``, the mean class shares of the row's leaves, and ``prediction``."""
        n = len(self.splits)
        df = df.withColumns({f"_leaf{t}": F.expr(leaf_of(tree)) for t, tree in enumerate(self.splits)})
        each = []
        for c in range(len(self.classes)):
            parts = []
            for t, tree in enumerate(self.splits):
                leaves = sorted({child for _, _, *children in tree.values() for child in children} - set(tree))
                cases = " ".join(f"WHEN {leaf} THEN {self.shares(t, leaf)[c]!r}D" for leaf in leaves)
                parts.append(f"CASE _leaf{t} {cases} END")
            each.append(f"({' + '.join(parts)}) / {float(n)!r}D")
        df = df.withColumn("proba", F.expr(f"array({', '.join(each)})"))
        return df.withColumn("prediction", predicted_class("proba", self.classes)).drop(*[f"_leaf{t}" for t in range(n)])


def leaf_of(tree: dict, node: int = 0) -> str:
    """The leaf a row falls into, as SQL text."""
    if node not in tree:
        return str(node)
    feature, threshold, left, right = tree[node]
    return f"CASE WHEN `{feature}` <= {float(threshold)!r}D THEN {leaf_of(tree, left)} ELSE {leaf_of(tree, right)} END"


def tree_contributions(model, df: DataFrame, key: str) -> DataFrame:
    """``key, prediction, proba, phi, base`` of a model that has a ``node_table``."""
    scored = model.with_scores(df.drop("proba", "prediction")).select(key, *model.features, "prediction", "proba")
    start = getattr(model, "start", None)
    return tree_shap(model.node_table(df.sparkSession), scored, model.features, len(model.classes), start).drop(*model.features)


def tree_report(model, spark: SparkSession) -> DataFrame:
    """``tree, node, feature, threshold, left, right, cover`` and one share per class: the model as a table to read."""
    names = F.array(*[F.lit(f) for f in model.features])
    shares = [F.get("value", F.lit(i)).alias(f"value_{c}") for i, c in enumerate(model.classes)]
    named = F.when(F.col("feature") >= 0, F.element_at(names, F.col("feature") + 1))
    leaf = F.col("feature") < 0
    return model.node_table(spark).select(
        "tree", "node", named.alias("feature"), F.when(~leaf, F.col("threshold")).alias("threshold"), "left", "right", "cover",
        *[F.when(leaf, s).alias(f"value_{c}") for s, c in zip(shares, model.classes)],
    )
