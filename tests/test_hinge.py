"""Machines fitted in shared scans against MLlib's, and what the scans keep."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from culprit import fixed_values as V
from culprit.operators import estimators as M
from culprit.operators import hinge as H


@pytest.fixture(scope="module")
def rows(spark, incidents):
    table, classes = M.index_label(incidents.withColumn("fold", F.pmod(F.col("incident_id"), F.lit(5)).cast("int")))
    return table.coalesce(2).persist(), classes


def objective(z, head, positive, penalty):
    w = head.coefficients.toArray()
    return np.maximum(0, 1 - np.where(positive, 1, -1) * (z @ w + head.intercept)).mean() + penalty * (w @ w) / 2


@pytest.mark.parametrize("params", [{"C": 1, "kernel": "linear"}, {"C": 10, "gamma": "scale"}])
def test_no_worse_than_a_hundred_steps_of_mllib(rows, params):
    table, classes = rows
    model = M.fit(table, M.ModelSpec("SVM", "svm", {}, {"dims": 24}), params, V.SIGNALS, classes, calibrate=False)
    wide = model.prepared(table).select("label_index", "_features")
    found = wide.collect()
    z, y = np.array([r[1].toArray() for r in found]), np.array([r[0] for r in found])
    penalty = 1.0 / (params["C"] * len(y))
    for i in (0,):
        marked = wide.withColumn("_is", (F.col("label_index") == i).cast("double"))
        plain = LinearSVC(labelCol="_is", featuresCol="_features", regParam=penalty, maxIter=100, standardization=False).fit(marked)
        assert objective(z, model.heads.stages[i], y == i, penalty) <= objective(z, plain, y == i, penalty) * 1.001


def test_a_left_out_fold_is_not_seen(rows):
    table, classes = rows
    spec = M.ModelSpec("SVM", "svm", {}, {})
    part = M.machine_rows(table, V.SIGNALS, F.col("fold"), 1)
    prep = M.fit_prep(table, "svm", V.SIGNALS, table.count())
    machine = lambda: H.Machines(*M.scaling_of(prep), 1e-3, M.kernel_of(spec, {"kernel": "linear"}, prep, 9, 1), 2)
    whole, rest = machine(), machine()
    H.fit_all(part, [whole], V.SIGNALS, len(classes), 40)
    H.fit_all(part.filter("_fold <> 2"), [rest], V.SIGNALS, len(classes), 40)
    part.unpersist()
    assert whole.weights == pytest.approx(rest.weights, abs=1e-6)


def test_larger_tables_begin_on_some_rows_and_end_at_the_same_loss(rows, monkeypatch):
    table, classes = rows
    part = M.machine_rows(table, V.SIGNALS, F.col("fold"), 1)
    prep = M.fit_prep(table, "svm", V.SIGNALS, table.count())
    found = []
    for most in (100, 10**6):
        machine = H.Machines(*M.scaling_of(prep), 1e-2)
        H.fit_all(part, [machine], V.SIGNALS, len(classes), 1000, most)
        found.append(machine.weights)
    x = (np.array([[float(v) for v in r] for r in table.select(*V.SIGNALS).collect()]) - machine.mean) * machine.factor
    y = np.array([r[0] for r in table.select("label_index").collect()])
    loss = [[np.maximum(0, 1 - np.where(y == c, 1, -1) * (x @ w[c, :-1] + w[c, -1])).mean() + 5e-3 * (w[c, :-1] @ w[c, :-1]) for c in range(len(classes))] for w in found]
    assert loss[0] == pytest.approx(loss[1], rel=1e-3)


def test_only_the_features_themselves_are_kept(spark, rows, monkeypatch):
    """256 random features of every row on the disk, for several fits at a time, was what failed by disk."""
    table, classes = rows
    kept, fit_all = [], M.fit_all
    monkeypatch.setattr(M, "fit_all", lambda df, *more: kept.append(df.columns) or fit_all(df, *more))
    M.fit(table, M.ModelSpec("SVM", "svm", {}, {"max_iter": 2}), {"C": 1}, V.SIGNALS, classes, calibrate=False)
    assert kept == [["_y", "_fold", *V.SIGNALS]]


def test_search_shares_the_scans_of_all_points_and_folds(rows, monkeypatch):
    table, classes = rows
    fits, fit_all = [], M.fit_all
    monkeypatch.setattr(M, "fit_all", lambda df, machines, *more: fits.append(len(machines)) or fit_all(df, machines, *more))
    spec = M.ModelSpec("SVM (RBF)", "svm", {"C": [0.1, 1], "gamma": ["scale", "auto"]}, {"max_iter": 3, "dims": 16, "calibration_folds": 5})
    model, results = M.grid_search(table, spec, V.SIGNALS, classes)
    assert fits == [20, 6]  # the points on the folds; the best on all rows and without each part
    assert [(r["params"], r["fold"]) for r in results] == [(p, k) for k in range(5) for p in spec.points()]
    assert model.params == M.best_point(spec.points(), results) and len(model.calibration) == 6
