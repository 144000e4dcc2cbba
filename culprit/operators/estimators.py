"""The classifier families, fitted with MLlib.

Support vector machines are fitted by ``hinge``, whose weights become MLlib's models.

A fitted model is two MLlib pipelines, ``prep`` (features) and ``heads`` (one multiclass
model, or one binary model per class), and a card with what MLlib does not keep: class
names, parameters and calibration. Boosting is not MLlib's, which knows two classes only;
see ``boosting``.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LinearSVCModel,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.common import _py2java
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culprit import fixed_values as V
from culprit.operators.boosting import BINS, BoostedModel, fit_boosting, search_boosting
from culprit.operators.hinge import Machines, fit_all, fourier_features, fourier_map
from culprit.operators.logistic import MOST_PARAMETERS, search_logistic
from culprit.operators.scoring import predicted_class
from culprit.operators.trees import forest_nodes

# Depth that stands for "no limit": MLlib accepts at most 30.
DEEPEST = 30
TASK_VALUES = 1 << 23  # feature values that are worth a task of every scan of a machine's fit
MOST_STEPS = 1_000  # of a machine; its tolerance ends it long before


@dataclass(frozen=True)
class ModelSpec:
    """A family with its parameter grid. ``options`` go to every fit of the family."""

    name: str
    family: str
    grid: dict[str, list]
    options: dict = field(default_factory=dict)

    def points(self) -> list[dict]:
        """All grid points; the last parameter by name varies fastest."""
        names = sorted(self.grid)
        return [dict(zip(names, values)) for values in product(*[self.grid[n] for n in names])]


FAMILIES = {
    "Logistic Regression": "logistic",
    "Random Forest": "forest",
    "Gradient Boosting": "boosting",
    "SVM (RBF)": "svm",
    "SVM": "svm",
}


def registry(grids: dict[str, dict] | None = None, options: dict[str, dict] | None = None) -> list[ModelSpec]:
    """The four families, with the given grids or the default ones."""
    options = options or {}
    return [
        ModelSpec(name, FAMILIES[name], grid, options.get(name, {})) for name, grid in (grids or V.GRIDS).items()
    ]


def needs_scaling(family: str) -> bool:
    return family in ("logistic", "svm")


def index_label(df: DataFrame, label: str = V.LABEL) -> tuple[DataFrame, list[str]]:
    """Add ``label_index`` by alphabetical class order, and return the classes."""
    model = StringIndexer(
        inputCol=label, outputCol="label_index", stringOrderType="alphabetAsc", handleInvalid="error"
    ).fit(df)
    return model.transform(df), model.labels


class FittedModel:
    """A fitted classifier that scores tables; see ``explain`` for the interface."""

    def __init__(
        self,
        name: str,
        family: str,
        params: dict,
        classes: list[str],
        features: list[str],
        prep: PipelineModel,
        heads: PipelineModel,
        fourier: dict | None = None,
        calibration: list | None = None,
    ):
        self.name, self.family, self.params = name, family, params
        self.classes, self.features = list(classes), list(features)
        self.prep, self.heads = prep, heads
        self.fourier, self.calibration = fourier, calibration

    @property
    def kind(self) -> str:
        if self.family == "svm":
            return "linear" if self.fourier is None else "kernel"
        return {"logistic": "linear", "forest": "tree"}[self.family]

    def prepared(self, df: DataFrame) -> DataFrame:
        return with_fourier(self.prep.transform(df), self.fourier)

    def margins(self, df: DataFrame) -> DataFrame:
        """Add ``_margins``, one binary margin per class."""
        scored = self.heads.transform(self.prepared(df))
        each = [vector_to_array(F.col(f"_raw{i}"))[1] for i in range(len(self.classes))]
        return scored.withColumn("_margins", F.array(*each))

    def with_scores(self, df: DataFrame) -> DataFrame:
        """Add ``proba`` (in class order) and ``prediction``; all other columns stay."""
        kept = df.columns
        if self.family in ("logistic", "forest"):
            scored = self.heads.transform(self.prepared(df))
            scored = scored.withColumn("proba", vector_to_array("_probability"))
            best = "proba"
        else:
            scored = self.margins(df)
            # Margins that were not calibrated are taken for half the log-odds.
            lines = self.calibration or [(2.0, 0.0)] * len(self.classes)
            scored = scored.withColumns(
                {f"_p{i}": F.expr(f"1D / (1D + exp(-({a!r}D * _margins[{i}] + {b!r}D)))") for i, (a, b) in enumerate(lines)}
            )
            total = " + ".join(f"_p{i}" for i in range(len(lines)))
            shares = ", ".join(f"_p{i} / ({total})" for i in range(len(lines)))
            scored = scored.withColumn("proba", F.expr(f"array({shares})"))
            best = "_margins"
        scored = scored.withColumn("prediction", predicted_class(best, self.classes))
        return scored.select(*kept, "prediction", "proba")

    def _linear(self) -> tuple[list[list[float]], list[float]]:
        if self.kind != "linear":
            raise ValueError(f"{self.name}: coefficients are not available for a non-linear model")
        if self.family == "logistic":
            head = self.heads.stages[0]
            return head.coefficientMatrix.toArray().tolist(), head.interceptVector.toArray().tolist()
        return (
            [h.coefficients.toArray().tolist() for h in self.heads.stages],
            [float(h.intercept) for h in self.heads.stages],
        )

    def coefficients(self) -> list[tuple[str, str, float]]:
        """(feature, class, weight on the scaled feature)."""
        weights, _ = self._linear()
        return [
            (f, c, float(w)) for c, row in zip(self.classes, weights) for f, w in zip(self.features, row)
        ]

    @property
    def weights(self) -> list[list[float]]:
        """Weights in the units of the unscaled features."""
        factors, _ = self._scaling()
        return [[w * s for w, s in zip(row, factors)] for row in self._linear()[0]]

    @property
    def intercepts(self) -> list[float]:
        factors, means = self._scaling()
        rows, intercepts = self._linear()
        return [b - sum(w * s * m for w, s, m in zip(row, factors, means)) for b, row in zip(intercepts, rows)]

    def _scaling(self) -> tuple[list[float], list[float]]:
        scaler, factor = self.prep.stages[1], self.prep.stages[2]
        factors = [
            float(k) / s if s > 0 else 0.0 for k, s in zip(factor.getScalingVec().toArray(), scaler.std.toArray())
        ]
        return factors, [float(m) for m in scaler.mean.toArray()]

    def node_table(self, spark: SparkSession) -> DataFrame:
        """The trees of a forest as rows, see ``trees``."""
        if self.kind != "tree":
            raise ValueError(f"{self.name} has no forest")
        return forest_nodes(spark, self.heads.stages[0])

    def tree_importance(self) -> list[tuple[str, float]]:
        """Impurity importance, largest first."""
        if self.kind != "tree":
            raise ValueError(f"{self.name} has no trees")
        mean = self.heads.stages[0].featureImportances.toArray()
        order = np.argsort(-mean, kind="stable")
        return [(self.features[j], float(mean[j])) for j in order]


def with_fourier(df: DataFrame, fourier: dict | None) -> DataFrame:
    """Random Fourier features of the RBF kernel (Rahimi and Recht, 2007).

    A plain matrix product per Arrow batch; frequencies depend on the seed alone.
    """
    if fourier is None:
        return df
    frequencies, phases = fourier_map(fourier)

    @F.pandas_udf("array<double>")
    def project(x: pd.Series) -> pd.Series:
        if len(x) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(fourier_features(np.stack(x.to_list()), frequencies, phases)))

    return df.withColumn("_features", array_to_vector(project(vector_to_array("_features"))))


def fit_prep(df: DataFrame, family: str, features: list[str], n: int) -> PipelineModel:
    """Vector of the features, scaled by the population deviation where the family needs it."""
    if not needs_scaling(family):
        return PipelineModel([VectorAssembler(inputCols=features, outputCol="_features")])
    assembler = VectorAssembler(inputCols=features, outputCol="_unscaled")
    scaler = StandardScaler(inputCol="_unscaled", outputCol="_scaled", withMean=True, withStd=True)
    # MLlib divides by the sample deviation; this turns it into the population deviation.
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    resize = ElementwiseProduct(
        inputCol="_scaled", outputCol="_features", scalingVec=Vectors.dense([factor] * len(features))
    )
    return PipelineModel([assembler, scaler.fit(assembler.transform(df)), resize])


def kernel_width(gamma, prep: PipelineModel) -> float:
    """``scale`` is 1 / (features x variance of the scaled values), ``auto`` 1 / features."""
    std = prep.stages[1].std.toArray()
    if gamma == "scale":
        varying = float((std > 0).sum())
        return 1.0 / varying if varying else 1.0
    return 1.0 / len(std) if gamma == "auto" else float(gamma)


def fit(
    df: DataFrame,
    spec: ModelSpec,
    params: dict,
    features: list[str],
    classes: list[str],
    seed: int = V.SEED,
    parallelism: int = 4,
    calibrate: bool = True,
) -> FittedModel | BoostedModel:
    """Fit one family with one grid point on a table with ``label_index``."""
    if spec.family == "boosting":
        return fit_boosting(df, params, features, classes, spec.options.get("bins", BINS))
    n = df.count()
    prep = fit_prep(df, spec.family, features, n)
    if spec.family == "logistic":
        head = LogisticRegression(
            labelCol="label_index",
            featuresCol="_features",
            probabilityCol="_probability",
            rawPredictionCol="_rawPrediction",
            predictionCol="_prediction",
            family="multinomial",
            elasticNetParam=0.0,
            regParam=1.0 / (params["C"] * n),
            maxIter=spec.options.get("max_iter", 1000),
            standardization=False,
        )
        heads = PipelineModel([head.fit(prep.transform(df))])
        return FittedModel(spec.name, spec.family, params, classes, features, prep, heads)
    if spec.family == "forest":
        head = RandomForestClassifier(
            labelCol="label_index",
            featuresCol="_features",
            probabilityCol="_probability",
            rawPredictionCol="_rawPrediction",
            predictionCol="_prediction",
            numTrees=params["n_estimators"],
            maxDepth=min(params["max_depth"] or DEEPEST, DEEPEST),
            featureSubsetStrategy="sqrt",
            maxBins=spec.options.get("max_bins", 128),
            seed=seed,
        )
        heads = PipelineModel([head.fit(prep.transform(df))])
        return FittedModel(spec.name, spec.family, params, classes, features, prep, heads)
    fourier = kernel_of(spec, params, prep, len(features), seed)
    folds = spec.options.get("calibration_folds", V.FOLDS)
    part = F.pmod(F.col("fold"), F.lit(folds)) if calibrate else F.lit(0)
    rows = machine_rows(df, features, part, n * (fourier["dims"] if fourier else len(features)))
    left = {None: n}
    if calibrate:
        held = {r["_fold"]: r["count"] for r in rows.groupBy("_fold").count().collect()}
        left |= {k: n - held.get(k, 0) for k in range(folds)}
    mean, factor = scaling_of(prep)
    wanted = [Machines(mean, factor, 1.0 / (params["C"] * max(1, rest)), fourier, k) for k, rest in left.items()]
    heads, *unseen = one_per_class(rows, wanted, features, len(classes), spec.options.get("max_iter", MOST_STEPS))
    rows.unpersist()
    calibration = None
    if calibrate:
        wide = with_fourier(prep.transform(df), fourier).select("label_index", "_features", "fold")
        unseen = iter(unseen)  # platt asks for the parts in their order
        calibration = platt(wide, len(classes), folds, lambda rows: next(unseen), parallelism)
    return FittedModel(spec.name, spec.family, params, classes, features, prep, heads, fourier, calibration)


def kernel_of(spec: ModelSpec, params: dict, prep: PipelineModel, inputs: int, seed: int) -> dict | None:
    """The random features that stand for the kernel; None for linear machines."""
    if params.get("kernel", "rbf") != "rbf":
        return None
    gamma = kernel_width(params.get("gamma", "scale"), prep)
    return {"gamma": gamma, "dims": spec.options.get("dims", 256), "seed": seed, "inputs": inputs}


def scaling_of(prep: PipelineModel) -> tuple[np.ndarray, np.ndarray]:
    """Means, and factors to the population deviation (0 for a feature that does not vary)."""
    scaler, resize = prep.stages[1], prep.stages[2]
    std = scaler.std.toArray()
    return scaler.mean.toArray(), np.divide(resize.getScalingVec().toArray(), std, out=np.zeros(len(std)), where=std > 0)


def machine_rows(df: DataFrame, features: list[str], part, values: int) -> DataFrame:
    """The unscaled features, class and fold of every row, kept for the scans of a fit.

    A scan of few rows is mostly the cost of its tasks, and a fit has one or two for every step.
    """
    doubles = [F.col(f).cast("double").alias(f) for f in features]
    rows = df.select(F.col("label_index").cast("int").alias("_y"), part.cast("int").alias("_fold"), *doubles)
    # Tasks read their rows block by block, so more tasks than keep the cores busy only send more sums.
    most = 2 * df.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(min(math.ceil(values / TASK_VALUES) or 1, most)).persist()


def one_per_class(rows: DataFrame, machines: list[Machines], features: list[str], classes: int, most_steps: int) -> list[PipelineModel]:
    """For each of ``machines`` a binary model for every class against the rest; all are fitted in the same scans."""
    fit_all(rows, machines, features, classes, most_steps)
    sc, out = SparkSession.active().sparkContext, []
    for m in machines:
        for i, weights in enumerate(m.weights):
            if not np.isfinite(weights).all():
                raise ValueError(f"the fit of class {i} did not converge: its weights are not finite")
        out.append(PipelineModel([_head(sc, i, weights) for i, weights in enumerate(m.weights)]))
    return out


def _head(sc, i: int, weights: np.ndarray) -> LinearSVCModel:
    """MLlib's model with these weights, the constant last."""
    vector = _py2java(sc, Vectors.dense(weights[:-1].tolist()))
    made = sc._jvm.org.apache.spark.ml.classification.LinearSVCModel(f"LinearSVC_{uuid.uuid4().hex[:12]}", vector, float(weights[-1]))
    model = LinearSVCModel(made)
    return model.setFeaturesCol("_features").setRawPredictionCol(f"_raw{i}").setPredictionCol(f"_prediction{i}")


def search_machines(
    train: DataFrame, spec: ModelSpec, points: list[dict], features: list[str], classes: list[str], label: str, folds: int, seed: int, parallelism: int
) -> list[dict]:
    """Accuracy of every point on every fold. All machines share their scans; a fold has its own scaling."""
    wanted, trials = [], []
    for k in range(folds):
        rest = train.filter(F.col("fold") != k)
        n = rest.count()
        prep = fit_prep(rest, spec.family, features, n)
        for p in points:
            fourier = kernel_of(spec, p, prep, len(features), seed)
            wanted.append(Machines(*scaling_of(prep), 1.0 / (p["C"] * n), fourier, k))
            trials.append((p, k, prep, fourier))
    # As many values as the machines of a point and a fold each read.
    values = train.count() * max(m.width for m in wanted) * len({m.space for m in wanted})
    rows = machine_rows(train, features, F.col("fold"), values)
    found = one_per_class(rows, wanted, features, len(classes), spec.options.get("max_iter", MOST_STEPS))
    rows.unpersist()

    def trial(which):
        (p, k, prep, fourier), heads = which
        model = FittedModel(spec.name, spec.family, p, classes, features, prep, heads, fourier)
        return {"params": p, "fold": k, "accuracy": accuracy(model, train.filter(F.col("fold") == k), label)}

    with ThreadPool(parallelism) as pool:
        return pool.map(trial, list(zip(trials, found)))


def platt(df: DataFrame, n: int, folds: int, fit_heads: Callable, parallelism: int) -> list[tuple[float, float]]:
    """Line that turns each class's margin into log-odds (Platt, 1999).

    It is fitted on margins of rows the margin model has not seen: each part of the folds
    is scored by models of the others. The lines of the classes are fitted side by side.
    """
    part = F.pmod(F.col("fold"), F.lit(folds))
    unseen = None
    for k in range(folds):
        heads = fit_heads(df.filter(part != k))
        scored = heads.transform(df.filter(part == k))
        scored = scored.select("label_index", *[vector_to_array(f"_raw{i}")[1].alias(f"_m{i}") for i in range(n)])
        unseen = scored if unseen is None else unseen.unionByName(scored)
    unseen = unseen.persist()

    def line_of(i: int) -> tuple[float, float]:
        rows = VectorAssembler(inputCols=[f"_m{i}"], outputCol="_m").transform(
            unseen.withColumn("_is", (F.col("label_index") == i).cast("double"))
        )
        # The small penalty bounds the slope when all margins of a class are nearly equal.
        line = LogisticRegression(
            featuresCol="_m", labelCol="_is", maxIter=100, regParam=1e-6, standardization=False
        ).fit(rows)
        return float(line.coefficients[0]), float(line.intercept)

    with ThreadPool(min(parallelism, n)) as pool:
        lines = pool.map(line_of, range(n))
    unseen.unpersist()
    return lines


def accuracy(model: FittedModel, df: DataFrame, label: str) -> float:
    scored = model.with_scores(df.select(label, *model.features))
    return scored.agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("a")).first()["a"]


def grid_search(
    train: DataFrame,
    spec: ModelSpec,
    features: list[str],
    classes: list[str],
    label: str = V.LABEL,
    folds: int = V.FOLDS,
    seed: int = V.SEED,
    parallelism: int = 4,
) -> tuple[FittedModel, list[dict]]:
    """Mean accuracy of every grid point over the folds, and the best point fitted on all rows.

    ``train`` has ``label_index`` and ``fold``. Boosting, machines and logistic regression fit
    all points and folds in the same scans, logistic regression up to so many weights as one step can hold. For the others the loop over
    points and folds is written out. Every fit is a set of distributed jobs; ``parallelism`` of them are in flight at a time.
    """
    points = spec.points()
    if spec.family == "boosting":
        return search_boosting(train, points, features, classes, folds, spec.options.get("bins", BINS))
    if spec.family == "logistic" and len(classes) * (len(features) + 1) <= MOST_PARAMETERS:
        results, _ = search_logistic(train, [p["C"] for p in points], features, classes, folds)
        return fit(train, spec, best_point(points, results), features, classes, seed, parallelism), results
    if spec.family == "svm":
        results = search_machines(train, spec, points, features, classes, label, folds, seed, parallelism)
        return fit(train, spec, best_point(points, results), features, classes, seed, parallelism), results
    trials = [(p, k) for k in range(folds) for p in points]

    def trial(which):
        p, k = which
        model = fit(train.filter(F.col("fold") != k), spec, p, features, classes, seed, 1, calibrate=False)
        return {"params": p, "fold": k, "accuracy": accuracy(model, train.filter(F.col("fold") == k), label)}

    with ThreadPool(parallelism) as pool:
        results = pool.map(trial, trials)
    return fit(train, spec, best_point(points, results), features, classes, seed, parallelism), results


def best_point(points: list[dict], results: list[dict]) -> dict:
    """The grid point of the best mean accuracy over the folds, the first of equals."""
    means = [float(np.mean([r["accuracy"] for r in results if r["params"] == p])) for p in points]
    return points[int(np.argmax(means))]
