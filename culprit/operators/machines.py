"""Support vector machines of class pairs, linear or over landmarks of a kernel.

One machine per pair of classes, as in one-against-one classification. The hinge is rounded
at its corner (Chapelle, 2007), so that Newton steps apply: one scan per step sums loss,
gradient and curvature of the machines of all pairs and folds. Margins become pair
probabilities by a line fitted on rows that a machine has not seen (Platt, 1999), and pair
probabilities become class probabilities by pairwise coupling (Wu, Lin and Weng, 2004).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culprit import fixed_values as V
from culprit.operators.splits import sample_n
from culprit.sources.shared import written

LANDMARKS = 128
ROUNDING = (1.0, 0.5, 0.25, 0.1)  # half the width of the rounded corner, in margins; a machine starts at the first
LEAST_SHARE = 1e-9  # of the largest eigenvalue of the landmarks' kernel matrix
LARGEST_GRADIENT = 1e-8  # per row
MOST_STEPS = 100
LEAST_PAIR = 1e-7  # pair probabilities stay this far from 0 and 1
TASK_ROWS = 2_000
FIRST_ROWS = 50_000  # rows by hash on which machines of larger tables begin


@dataclass
class FeatureMap:
    """Scaled features or, with landmarks, their image under the factorised kernel.

    With landmarks L and kernel k, a row x becomes k(x, L) K(L, L) ** (-1/2), so that products
    of rows are the kernel's best approximation in the span of the landmarks (Nystroem).
    """

    mean: np.ndarray
    factor: np.ndarray
    gamma: float | None = None
    landmarks: np.ndarray | None = None  # scaled
    root: np.ndarray | None = None

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) * self.factor

    def __call__(self, x: np.ndarray) -> np.ndarray:
        rows = self.scaled(x)
        return rows if self.landmarks is None else kernel(rows, self.landmarks, self.gamma) @ self.root

    @property
    def width(self) -> int:
        return len(self.mean) if self.root is None else self.root.shape[1]


def kernel(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    distance = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.exp(-gamma * np.maximum(distance, 0))


def kernel_width(gamma, mean_variance: float, width: int) -> float:
    """``scale`` is 1 / (features x variance of the scaled values), ``auto`` 1 / features."""
    if gamma == "scale":
        return 1.0 / (width * mean_variance) if mean_variance else 1.0
    return 1.0 / width if gamma == "auto" else float(gamma)


def feature_map(df: DataFrame, features: list[str], key: str | None = None, gamma=None, landmarks: int = LANDMARKS, seed: int = V.SEED) -> FeatureMap:
    """Scaling of the table and, where ``gamma`` is given, landmarks drawn from it by hash.

    The sample is ``landmarks`` rows at most; equal ones count once, and directions in which
    their kernel matrix vanishes are left out.
    """
    row = df.agg(*[f(F.col(n).cast("double")).alias(f"{p}_{n}") for n in features for p, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    std = np.array([row[f"s_{n}"] or 0.0 for n in features])
    out = FeatureMap(np.array([row[f"m_{n}"] or 0.0 for n in features]), np.divide(1.0, std, out=np.zeros(len(std)), where=std > 0))
    if gamma is None:
        return out
    sample = sample_n(df, key, landmarks, seed, "landmarks").select(*[F.col(n).cast("double").alias(n) for n in features])
    out.landmarks = np.unique(out.scaled(np.array([list(r) for r in sample.collect()], dtype=np.float64).reshape(-1, len(features))), axis=0)
    out.gamma = kernel_width(gamma, float((std > 0).mean()), len(features))
    values, axes = np.linalg.eigh(kernel(out.landmarks, out.landmarks, out.gamma))
    kept = values > LEAST_SHARE * values.max()
    out.root = axes[:, kept] / np.sqrt(values[kept])
    return out


def rounded_hinge(margin: np.ndarray, width: float = ROUNDING[-1]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hinge loss with a parabola at its corner, its slope and its curvature."""
    short = 1 + width - margin
    bend = np.abs(1 - margin) <= width
    line = margin < 1 - width
    loss = np.where(bend, short * short / (4 * width), np.where(line, 1 - margin, 0.0))
    return loss, np.where(bend, -short / (2 * width), np.where(line, -1.0, 0.0)), np.where(bend, 1 / (2 * width), 0.0)


@dataclass
class Machine:
    """A machine between two classes (the first is the positive one), without a fold or on all rows."""

    pair: tuple[int, int]
    without: int | None = None
    weights: np.ndarray = field(default=None, repr=False)
    stage: int = 0  # of the rounding
    steps: int = 0
    done: bool = False


def _read(batch: pa.RecordBatch, features: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.stack([batch.column(f).to_numpy(zero_copy_only=False) for f in features], axis=1)
    return x, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("_y", "_fold"))


def _with_constant(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([rows, np.ones((len(rows), 1))], axis=1)


def _scan(machines: list[Machine], mapping: FeatureMap, features: list[str], block: int = 4_096):
    live = [(i, m) for i, m in enumerate(machines) if not m.done]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            every, labels, folds = _read(batch, features)
            for at in range(0, len(labels), block):
                part = slice(at, at + block)
                rows, y, fold = _with_constant(mapping(every[part])), labels[part], folds[part]
                for i, m in live:
                    seen = np.flatnonzero(((y == m.pair[0]) | (y == m.pair[1])) & (fold != m.without if m.without is not None else True))
                    x, sign = rows[seen], np.where(y[seen] == m.pair[0], 1.0, -1.0)
                    loss, slope, bend = rounded_hinge(sign * (x @ m.weights), ROUNDING[m.stage])
                    curved = bend > 0
                    sums = np.concatenate([[loss.sum(), len(seen)], x.T @ (sign * slope), (x[curved].T @ (x[curved] * bend[curved, None])).ravel()])
                    total[i] = total.get(i, 0.0) + sums
        if total:
            values = np.stack(list(total.values()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1]), pa.int32()), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), lists], names=["machine", "sums"])

    return add


def fit_machines(rows: DataFrame, machines: list[Machine], mapping: FeatureMap, c: float, features: list[str], most_steps: int = MOST_STEPS) -> None:
    """Minimise half the squared weights plus ``c`` times the rounded hinge, for all machines at once.

    The constant has no penalty. A step that does not lower the loss is halved. With a narrow
    corner few rows have curvature, so a machine is first fitted with a wide one and goes on
    from there. Machines that have weights begin at those and at their corner.
    """
    d = mapping.width + 1
    penalty = np.append(np.ones(d - 1), 0.0)
    for m in machines:
        if m.weights is None:
            m.weights = np.zeros(d)
        m.steps, m.done = 0, False
    state = [(None, math.inf, None)] * len(machines)
    while not all(m.done for m in machines):
        parts = rows.mapInArrow(_scan(machines, mapping, features), "machine int, sums array<double>")
        found = parts.groupBy("machine").agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).collect()
        for m in machines:
            m.done = m.done or not found
        for r in found:
            m, sums = machines[r["machine"]], r["sums"].toArray()
            n, sums = sums[1], np.delete(sums, 1)
            loss = c * sums[0] + (penalty * m.weights**2).sum() / 2
            before, least, step = state[r["machine"]]
            m.steps += 1
            if loss > least + 1e-12 * abs(least) and np.abs(step).max() > 1e-12:
                step = step / 2
                m.weights, state[r["machine"]] = before + step, (before, least, step)
            else:
                gradient = c * sums[1 : d + 1] + penalty * m.weights
                last = m.stage == len(ROUNDING) - 1
                small = np.abs(gradient).max() <= (LARGEST_GRADIENT if last else 1e-3) * max(1.0, c * n)
                if small and not last:
                    m.stage, state[r["machine"]] = m.stage + 1, (None, math.inf, None)
                    continue
                if small:
                    m.done = True
                    continue
                curvature = c * sums[d + 1 :].reshape(d, d) + np.diag(penalty)
                # The constant has no curvature where no row lies in the bend.
                curvature[-1, -1] += 1e-6 * max(1.0, np.trace(curvature) / d)
                step = -np.linalg.solve(curvature, gradient)
                state[r["machine"]] = (m.weights, loss, step)
                m.weights = m.weights + step
            m.done = m.done or m.steps >= most_steps


def begin_machines(rows: DataFrame, machines: list[Machine], mapping: FeatureMap, c: float, features: list[str], most: int = FIRST_ROWS) -> None:
    """Where a table has far more than ``most`` rows, weights to begin with, from about that many.

    The loss has one minimum, so where a fit begins only decides how many scans of the whole
    table it takes. ``c`` grows as the rows are fewer, so the minimum stays about where it is.
    A machine whose classes have few rows among them begins at zero.
    """
    n = rows.count()
    if n <= 4 * most:
        return
    some = written(rows.filter(F.pmod(F.xxhash64("_y", "_fold", *features), F.lit(n // most)) == 0), "machines-first")
    found = {r["_y"]: r["n"] for r in some.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    fit_machines(some, machines, mapping, c * (n // most), features)
    for m in machines:
        if min(found.get(y, 0) for y in m.pair) < 4 * (mapping.width + 1):
            m.weights, m.stage = None, 0


def _line_scan(machines: list[Machine], lines: np.ndarray, mapping: FeatureMap, features: list[str], pairs: list[tuple[int, int]]):
    """Loss, gradient and curvature of every pair's line, on margins of rows its machines have not seen."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(pairs), 8))
        for batch in batches:
            x, y, fold = _read(batch, features)
            rows = _with_constant(mapping(x)) if len(y) else np.zeros((0, mapping.width + 1))
            for m in machines:
                seen = ((y == m.pair[0]) | (y == m.pair[1])) & (fold == m.without)
                if not seen.any():
                    continue
                p = pairs.index(m.pair)
                margin, truth = rows[seen] @ m.weights, (y[seen] == m.pair[0]).astype(np.float64)
                z = lines[p, 0] * margin + lines[p, 1]
                share = 1 / (1 + np.exp(-z))
                gap, bend = share - truth, share * (1 - share)
                loss = (np.logaddexp(0, z) - truth * z).sum()
                total[p] += [loss, (gap * margin).sum(), gap.sum(), (bend * margin * margin).sum(), (bend * margin).sum(), bend.sum(), truth.sum(), len(truth)]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, total.size + 1, 8), pa.int32()), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(pairs)), pa.int32()), lists], names=["pair", "sums"])

    return add


def fit_lines(rows: DataFrame, machines: list[Machine], mapping: FeatureMap, features: list[str], pairs: list[tuple[int, int]], most_steps: int = 50) -> np.ndarray:
    """Slope and level of every pair's log-odds; a small penalty bounds the slope."""
    unseen = [m for m in machines if m.without is not None]
    lines = np.zeros((len(pairs), 2))
    state = [(lines[i], math.inf, np.zeros(2)) for i in range(len(pairs))]
    done = np.zeros(len(pairs), bool)
    for _ in range(most_steps):
        parts = rows.mapInArrow(_line_scan(unseen, lines, mapping, features, pairs), "pair int, sums array<double>")
        for r in parts.groupBy("pair").agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).collect():
            p, (loss, ga, gb, aa, ab, bb, _, n) = r["pair"], r["sums"].toArray()
            if done[p] or not n:
                done[p] = True
                continue
            ridge = 1e-6 * n
            loss += ridge * lines[p, 0] ** 2 / 2
            before, least, step = state[p]
            if loss > least + 1e-12 * abs(least) and np.abs(step).max() > 1e-12:
                state[p] = (before, least, step / 2)
                lines[p] = before + step / 2
                continue
            gradient = np.array([ga + ridge * lines[p, 0], gb])
            done[p] = np.abs(gradient).max() < 1e-9 * max(1.0, n)
            if not done[p]:
                step = -np.linalg.solve(np.array([[aa + ridge, ab], [ab, bb + 1e-9 * n]]), gradient)
                state[p] = (lines[p].copy(), loss, step)
                lines[p] = lines[p] + step
        if done.all():
            break
    return lines


def coupled(pairs: list[tuple[int, int]], r: np.ndarray, classes: int) -> np.ndarray:
    """Class probabilities from pair probabilities (row, pair), by one small system per row.

    They minimise the sum over pairs of (r_ji p_i - r_ij p_j) ** 2 under the sum of one.
    """
    if classes == 2:
        return np.stack([r[:, 0], 1 - r[:, 0]], axis=1)
    r = np.clip(r, LEAST_PAIR, 1 - LEAST_PAIR)
    system = np.zeros((len(r), classes + 1, classes + 1))
    for (i, j), own in zip(pairs, r.T):
        other = 1 - own  # r_ji
        system[:, i, i] += other * other
        system[:, j, j] += own * own
        system[:, i, j] -= own * other
        system[:, j, i] -= own * other
    system[:, :classes, classes] = system[:, classes, :classes] = 1.0
    right = np.zeros((len(r), classes + 1, 1))
    right[:, classes] = 1.0
    p = np.maximum(np.linalg.solve(system, right)[:, :classes, 0], 0.0)
    return p / p.sum(axis=1, keepdims=True)


@dataclass
class PairMachines:
    """A fitted model: a machine and a line per pair; see ``explain`` for the interface."""

    name: str
    params: dict
    classes: list[str]
    features: list[str]
    mapping: FeatureMap = field(repr=False)
    weights: np.ndarray = field(repr=False)  # pair x (mapped features and a constant)
    lines: np.ndarray = field(repr=False)

    family = "pairs"

    @property
    def kind(self) -> str:
        return "pairs" if self.mapping.landmarks is None else "kernel"

    @property
    def pairs(self) -> list[tuple[int, int]]:
        return list(combinations(range(len(self.classes)), 2))

    def margins(self, x: np.ndarray) -> np.ndarray:
        return _with_constant(self.mapping(x)) @ self.weights.T

    def votes(self, margins: np.ndarray) -> np.ndarray:
        """The class with most pair wins, the first of equals."""
        count = np.zeros((len(margins), len(self.classes)))
        for (i, j), margin in zip(self.pairs, margins.T):
            count[:, i] += margin > 0
            count[:, j] += margin <= 0
        return count.argmax(axis=1)

    def shares(self, margins: np.ndarray) -> np.ndarray:
        return coupled(self.pairs, 1 / (1 + np.exp(-(margins * self.lines[:, 0] + self.lines[:, 1]))), len(self.classes))

    def with_scores(self, df: DataFrame) -> DataFrame:
        """Add ``proba`` (in class order) and ``prediction``, the class of most votes; all other columns stay."""
        features = self.features

        @F.pandas_udf("array<double>")
        def score(rows: pd.DataFrame) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype=object)
            margins = self.margins(rows[features].to_numpy(dtype=np.float64))
            return pd.Series(list(np.concatenate([self.shares(margins), self.votes(margins)[:, None]], axis=1)))

        n = len(self.classes)
        df = df.withColumn("_scored", score(F.struct(*[F.col(f).cast("double").alias(f) for f in features])))
        df = df.withColumn("proba", F.slice("_scored", 1, n))
        names = F.array(*[F.lit(c) for c in self.classes])
        return df.withColumn("prediction", F.element_at(names, F.get("_scored", F.lit(n)).cast("int") + 1)).drop("_scored")

    def coefficients(self) -> list[tuple[str, str, str, float]]:
        """(feature, class, other class, weight on the scaled feature) of the linear machines."""
        if self.mapping.landmarks is not None:
            raise ValueError(f"{self.name}: coefficients are not available for a non-linear model")
        return [(f, self.classes[i], self.classes[j], float(w)) for (i, j), row in zip(self.pairs, self.weights) for f, w in zip(self.features, row)]


def fit_pair_machines(
    df: DataFrame,
    params: dict,
    features: list[str],
    classes: list[str],
    key: str | None = None,
    folds: int = V.FOLDS,
    landmarks: int = LANDMARKS,
    seed: int = V.SEED,
    name: str = "SVM",
) -> PairMachines:
    """Machines of all class pairs over a table with ``label_index`` and ``fold``.

    ``params`` has ``C``, ``kernel`` ("linear" or "rbf") and ``gamma``. The machines of all
    rows and those without each fold, whose margins the lines are fitted on, come from the
    same scans.
    """
    gamma = params.get("gamma", "scale") if params.get("kernel", "rbf") == "rbf" else None
    mapping = feature_map(df, features, key, gamma, landmarks, seed)
    rows = df.select(F.col("label_index").cast("int").alias("_y"), F.col("fold").cast("int").alias("_fold"), *[F.col(f).cast("double").alias(f) for f in features])
    tasks = max(1, math.ceil(rows.count() / TASK_ROWS))
    rows = written(rows.coalesce(tasks), "machines").coalesce(tasks)
    pairs = list(combinations(range(len(classes)), 2))
    machines = [Machine(p, k) for p in pairs for k in (None, *range(folds))]
    begin_machines(rows, machines, mapping, params["C"], features)
    fit_machines(rows, machines, mapping, params["C"], features)
    lines = fit_lines(rows, machines, mapping, features, pairs)
    weights = np.stack([m.weights for m in machines if m.without is None])
    return PairMachines(name, dict(params), list(classes), list(features), mapping, weights, lines)
