"""Linear machines of one class against the rest, many of them in the same scans.

The machines of all classes, penalties, kernel widths and left-out folds share every scan: it
maps a block of rows once per scaling and kernel and adds loss and gradient of all machines.
The map (random Fourier features) is computed where it is used, so that no table of wide rows
is ever stored. The hinge is rounded at its corner (Chapelle, 2007), more narrowly in every
stage, and the driver takes quasi-Newton steps (L-BFGS) for each machine on its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culprit.operators.machines import FIRST_ROWS, rounded_hinge
from culprit.sources.shared import written

WIDTHS = (0.3, 0.03, 0.003, 0.001)  # half the width of the rounded corner in each stage
TOLERANCE = 1e-6  # of the loss, below which the last stage ends
KEPT_STEPS = 10
BLOCK = 2_048
MOST_BYTES = 1 << 25  # of sums that a scan may send to the driver without adding them up first


def fourier_map(fourier: dict) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and phases of the random features, which depend on the seed alone."""
    rng = np.random.default_rng(fourier["seed"])
    dims, inputs = fourier["dims"], fourier["inputs"]
    frequencies = rng.normal(size=(inputs, dims)) * math.sqrt(2.0 * fourier["gamma"])
    return frequencies, rng.uniform(0.0, 2.0 * math.pi, size=dims)


def fourier_features(x: np.ndarray, frequencies: np.ndarray, phases: np.ndarray) -> np.ndarray:
    return np.sqrt(2.0 / len(phases)) * np.cos(x @ frequencies + phases)


@dataclass
class Machines:
    """The machines of all classes for one scaling, kernel, penalty and left-out fold."""

    mean: np.ndarray
    factor: np.ndarray
    penalty: float  # of half the squared weights, beside the mean loss
    fourier: dict | None = None
    without: int | None = None
    weights: np.ndarray = field(default=None, repr=False)  # class x (features and a constant)

    @property
    def width(self) -> int:
        return len(self.mean) if self.fourier is None else self.fourier["dims"]

    @property
    def space(self) -> tuple:
        """Machines of one space share their mapped rows."""
        return (self.mean.tobytes(), self.factor.tobytes(), tuple(sorted((self.fourier or {}).items())))


class Descent:
    """Quasi-Newton steps of one machine; ``at`` is where its loss is wanted next."""

    def __init__(self, start: np.ndarray, penalty: float, most_steps: int):
        self.at, self.penalty, self.most_steps = start.astype(np.float64).copy(), penalty, most_steps
        self.steps = self.stage = 0
        self.done = False
        self._restart()

    def _restart(self) -> None:
        self.best, self.pairs, self.small = None, [], 0

    def take(self, loss: float, gradient: np.ndarray) -> None:
        """Loss and gradient at ``at``, the mean over the rows; the penalty is added here."""
        free = np.append(np.ones(len(self.at) - 1), 0.0)  # the constant has no penalty
        loss = loss + self.penalty * (free * self.at**2).sum() / 2
        gradient = gradient + self.penalty * free * self.at
        if self.best is not None:
            before, least, slope, step = self.best
            tiny = np.abs(step).max() <= 1e-12 * max(1.0, np.abs(before).max())
            if not loss <= least + 1e-4 * (slope @ step):
                if not tiny:
                    self.best = (before, least, slope, step / 2)
                    self.at = before + step / 2
                    return
                self.at, loss, gradient = before, least, slope
                self._end_stage()
                return
            change = gradient - slope
            if change @ step > 1e-12 * np.sqrt((change @ change) * (step @ step)):
                self.pairs = [*self.pairs, (step, change)][-KEPT_STEPS:]
            # Two small gains in a row: one alone may be a short step.
            small = least - loss <= self._tolerance * max(abs(loss), 1e-12)
            self.small = self.small + 1 if small else 0
            self.steps += 1
        if self.steps >= self.most_steps:
            self.done = True
        elif self.small >= 2 or np.abs(gradient).max() <= 1e-9:
            self._end_stage()
        else:
            self._step(loss, gradient)

    @property
    def _tolerance(self) -> float:
        return TOLERANCE if self.stage == len(WIDTHS) - 1 else 1e-4

    def _end_stage(self) -> None:
        if self.stage == len(WIDTHS) - 1:
            self.done = True
        else:
            self.stage += 1
            self._restart()

    def _step(self, loss: float, gradient: np.ndarray) -> None:
        step, shares = -gradient, []
        for s, c in reversed(self.pairs):
            share = (s @ step) / (s @ c)
            shares.append(share)
            step = step - share * c
        if self.pairs:
            s, c = self.pairs[-1]
            step = step * ((s @ c) / (c @ c))
        else:
            step = step / max(1.0, np.sqrt(gradient @ gradient))
        for (s, c), share in zip(self.pairs, reversed(shares)):
            step = step + (share - (c @ step) / (s @ c)) * s
        self.best = (self.at, loss, gradient, step)
        self.at = self.at + step


def _scan(groups: list[tuple], features: list[str]):
    """Loss and gradient of machines: ``groups`` has a space with the wanted (number, class, fold, width, weights)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [(fourier_map(first.fourier) if first.fourier else None) for first, _ in groups]
        stacked = []
        for _, wanted in groups:
            number, of, without, width, weights = zip(*wanted)
            without = np.array([-1 if f is None else f for f in without])
            stacked.append((np.array(number), np.array(of), without, np.array(width), np.stack(weights)))
        sums = [np.zeros((len(s[0]), s[4].shape[1] + 2)) for s in stacked]
        for batch in batches:
            every = np.stack([batch.column(f).to_numpy(zero_copy_only=False) for f in features], axis=1)
            y, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_y", "_fold"))
            for begin in range(0, len(y), BLOCK):
                part = slice(begin, begin + BLOCK)
                for (first, _), mapping, (_, of, without, width, weights), total in zip(groups, maps, stacked, sums):
                    rows = (every[part] - first.mean) * first.factor
                    rows = fourier_features(rows, *mapping) if mapping else rows
                    rows = np.concatenate([rows, np.ones((len(rows), 1))], axis=1)
                    sign = np.where(y[part][:, None] == of, 1.0, -1.0)
                    seen = fold[part][:, None] != without
                    loss, slope, _ = rounded_hinge(sign * (rows @ weights.T), width)
                    total[:, 0] += seen.sum(axis=0)
                    total[:, 1] += (loss * seen).sum(axis=0)
                    total[:, 2:] += (sign * slope * seen).T @ rows
        for (number, *_), total in zip(stacked, sums):
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, total.size + 1, total.shape[1]), pa.int32()), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), lists], names=["machine", "sums"])

    return add


def fit_machines(rows: DataFrame, machines: list[Machines], features: list[str], classes: int, most_steps: int) -> None:
    """Minimise half the penalised squared weights plus the mean rounded hinge, for all machines at once.

    ``rows`` has the unscaled features as doubles, ``_y`` (class number) and ``_fold``. Machines
    that have weights begin at those.
    """
    for m in machines:
        if m.weights is None:
            m.weights = np.zeros((classes, m.width + 1))
    each = [(m, c) for m in machines for c in range(classes)]
    tasks = rows.rdd.getNumPartitions()
    walks = [Descent(m.weights[c], m.penalty, most_steps) for m, c in each]
    while not all(w.done for w in walks):
        spaces: dict[tuple, tuple] = {}
        for i, ((m, c), w) in enumerate(zip(each, walks)):
            if not w.done:
                spaces.setdefault(m.space, (m, []))[1].append((i, c, m.without, WIDTHS[w.stage], w.at))
        groups = [(Machines(m.mean, m.factor, 0.0, m.fourier), wanted) for m, wanted in spaces.values()]
        parts = rows.mapInArrow(_scan(groups, features), "machine int, sums array<double>")
        if tasks * sum(8 * (w.at.size + 2) for w in walks if not w.done) > MOST_BYTES:
            parts = parts.groupBy("machine").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
        found = parts.toArrow()
        if not found.num_rows:
            break
        total: dict[int, np.ndarray] = {}
        for i, sums in zip(found["machine"].to_pylist(), found["sums"].to_numpy()):
            total[i] = total[i] + sums if i in total else sums
        for i, sums in total.items():
            n = max(1.0, sums[0])
            walks[i].take(sums[1] / n, sums[2:] / n)
    for (m, c), w in zip(each, walks):
        # A step that was not judged yet is not taken.
        m.weights[c] = w.at if w.done or w.best is None else w.best[0]


def fit_all(rows: DataFrame, machines: list[Machines], features: list[str], classes: int, most_steps: int, most: int = FIRST_ROWS) -> None:
    """Fit on all rows; where they are many, begin at the weights found on about ``most`` of them.

    The loss has one minimum, so where a fit begins only decides how many scans it takes.
    """
    n = rows.count()
    if n > 4 * most:
        some = written(rows.filter(F.pmod(F.xxhash64("_y", "_fold", *features), F.lit(n // most)) == 0), "machines-first")
        fit_machines(some, machines, features, classes, most_steps)
    fit_machines(rows, machines, features, classes, most_steps)
