import math
from threading import Barrier

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from culprit import fixed_values as V
from culprit.operators import estimators as M
from culprit.operators import explain, splits
from culprit.plans import stages
from culprit.sources import models as store
from culprit.sources.shared import written
from culprit.sources.tables import read_table, write_table

KEY = "incident_id"
SHORT = {"max_iter": 15, "calibration_folds": 2, "dims": 32}
CASES = [
    ("Logistic Regression", {}, {"C": 1}),
    ("Random Forest", {}, {"n_estimators": 10, "max_depth": 6}),
    ("Gradient Boosting", {}, {"n_estimators": 3, "learning_rate": 0.1}),
    ("SVM", SHORT, {"C": 1, "kernel": "linear"}),
    ("SVM (RBF)", SHORT, {"C": 1, "gamma": "scale"}),
]


@pytest.fixture(scope="module")
def parts(incidents):
    table = written(splits.stratified_split(incidents, KEY), "parts")
    train, classes = stages.training_table(table.filter("split = 'train'").drop("split"), KEY)
    return train.persist(), table.filter("split = 'val'").drop("split"), classes


@pytest.fixture(scope="module")
def fitted(parts):
    train, _, classes = parts
    return {
        name: M.fit(train, M.ModelSpec(name, M.FAMILIES[name], {}, options), params, V.SIGNALS, classes)
        for name, options, params in CASES
    }


@pytest.mark.parametrize("name", [c[0] for c in CASES])
def test_model_beats_the_majority_and_survives_saving(spark, parts, fitted, tmp_path, name):
    _, val, classes = parts
    model = fitted[name]
    before = {r[KEY]: (r["prediction"], r["proba"]) for r in model.with_scores(val).collect()}
    assert all(math.isclose(sum(p), 1.0) for _, p in before.values())
    assert M.accuracy(model, val, V.LABEL) > 0.4
    path = store.save_model(model, str(tmp_path / store.model_folder(name)))
    again = store.load_model(spark, path)
    after = {r[KEY]: (r["prediction"], r["proba"]) for r in again.with_scores(val).collect()}
    assert before == after and again.classes == classes


def test_scaler_uses_the_population_deviation(parts, fitted):
    train, _, _ = parts
    rows = fitted["Logistic Regression"].prep.transform(train).select("_features").collect()
    values = [r["_features"][5] for r in rows]
    mean = sum(values) / len(values)
    assert mean == pytest.approx(0, abs=1e-9)
    assert sum((v - mean) ** 2 for v in values) / len(values) == pytest.approx(1)


@pytest.mark.parametrize("name", ["Logistic Regression", "SVM"])
def test_linear_weights_in_raw_units_give_the_margins(parts, fitted, name):
    _, val, _ = parts
    model = fitted[name]
    scored = (
        model.margins(val) if name == "SVM" else model.heads.transform(model.prepared(val)).withColumn(
            "_margins", M.vector_to_array("_rawPrediction"))
    )
    for r in scored.limit(20).collect():
        for c in range(6):
            margin = model.intercepts[c] + sum(w * r[f] for w, f in zip(model.weights[c], V.SIGNALS))
            assert margin == pytest.approx(r["_margins"][c], abs=1e-7)


def test_reports_by_kind(fitted):
    trees = dict(fitted["Random Forest"].tree_importance())
    assert sum(trees.values()) == pytest.approx(1) and set(trees) == set(V.SIGNALS)
    assert len(fitted["Gradient Boosting"].tree_importance()) == 9
    assert len(fitted["Logistic Regression"].coefficients()) == 54
    assert len(fitted["SVM"].coefficients()) == 54
    with pytest.raises(ValueError, match="not available"):
        fitted["SVM (RBF)"].coefficients()
    with pytest.raises(ValueError):
        fitted["Logistic Regression"].tree_importance()
    assert [fitted[c[0]].kind for c in CASES] == ["linear", "tree", "boosting", "linear", "kernel"]


def test_forest_contributions_add_up(parts, fitted):
    _, val, _ = parts
    model = fitted["Random Forest"]
    rows = explain.contributions(model, val.orderBy(KEY).limit(3), val, KEY, kernel_rows=5).collect()
    scores = {r[KEY]: r["proba"] for r in model.with_scores(val).collect()}
    for r in rows:
        for c in range(6):
            assert r["base"][c] + sum(r["phi"][c]) == pytest.approx(scores[r[KEY]][c], abs=1e-9)


def test_grid_points_and_ties(parts):
    spec = M.ModelSpec("Random Forest", "forest", {"n_estimators": [1, 2], "max_depth": [None, 3]})
    assert spec.points()[:2] == [{"max_depth": None, "n_estimators": 1}, {"max_depth": None, "n_estimators": 2}]
    train, _, classes = parts
    same = M.ModelSpec("Logistic Regression", "logistic", {"C": [1, 1.0]}, {"max_iter": 5})
    model, results = M.grid_search(train, same, V.SIGNALS, classes, folds=2)
    assert len(results) == 4 and model.params["C"] == 1 and isinstance(model.params["C"], int)


def test_rbf_separates_a_ring_where_a_line_cannot(spark):
    df = spark.range(600).select(F.col("id").alias(KEY)).withColumns(
        {"x": F.sin(F.col(KEY)) * (1 + 2 * (F.col(KEY) % 2)), "y": F.cos(F.col(KEY)) * (1 + 2 * (F.col(KEY) % 2))}
    ).withColumn(V.LABEL, F.when(F.col(KEY) % 2 == 0, "inner").otherwise("outer"))
    train, classes = stages.training_table(df, KEY)
    found = {}
    for kernel in ("linear", "rbf"):
        spec = M.ModelSpec("SVM", "svm", {}, {"dims": 128, "max_iter": 30})
        model = M.fit(train, spec, {"C": 10, "kernel": kernel}, ["x", "y"], classes, calibrate=False)
        found[kernel] = M.accuracy(model, df, V.LABEL)
    assert found["rbf"] > 0.95 > 0.8 > found["linear"]


def test_load_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        store.load_model(spark, str(tmp_path / "none"))
    (tmp_path / "empty_pipeline").mkdir()
    with pytest.raises(TypeError):
        store.load_model(spark, str(tmp_path / "empty_pipeline"))
    with pytest.raises(FileNotFoundError):
        store.list_models(spark, str(tmp_path / "none"))
    assert store.list_models(spark, str(tmp_path)) == [f"{tmp_path}/empty_pipeline"]


def test_stages_end_to_end(spark, tmp_path):
    keys = spark.range(1200).withColumnRenamed("id", KEY)
    built = stages.build_dataset(keys, str(tmp_path / "data"))
    assert (built["n_train"], built["n_val"], built["n_eval"]) == (840, 180, 180)
    table = spark.read.parquet(built["splits_path"])
    train, val, rest = [table.filter(F.col("split") == s).drop("split") for s in ("train", "val", "eval")]
    specs = M.registry(
        {"Logistic Regression": {"C": [0.1, 1]}, "Random Forest": {"n_estimators": [5], "max_depth": [4]}}
    )
    done = stages.train_and_validate(train, val, str(tmp_path / "out"), KEY, specs=specs, folds=2)
    board = done["leaderboard"].collect()
    assert board[0]["val_f1_macro"] >= board[1]["val_f1_macro"] and done["best"] == board[0]["model_name"]
    assert spark.read.json(done["metrics_path"]).count() == 2
    models = stages.load_models(spark, str(tmp_path / "out" / "models"))
    assert [m.name for m in models.values()] == ["Logistic Regression", "Random Forest"]
    report, summary = stages.evaluate_models(models, rest, KEY, out=str(tmp_path / "eval"))
    assert all(r["roc_auc"] > 0.7 for r in summary.collect())
    assert report.filter("part = 'confusion'").agg(F.sum("value")).first()[0] == 2 * 180
    inputs = write_table(rest.drop(V.LABEL), str(tmp_path / "inputs.parquet"))
    out = str(tmp_path / "predictions.csv")
    stages.predict_table(spark, next(iter(models)), inputs, out)
    stored = read_table(spark, out)
    assert stored.count() == 180 and "proba_normal" in stored.columns and "prediction" in stored.columns
    tables, rows = stages.explain_models(
        models, rest, KEY, out=str(tmp_path / "explain"), n=5, kernel_rows=3
    )
    assert {r["method"] for r in rows.collect()} == {"shap_linear", "shap_tree"}
    assert tables.count() == 18


def test_calibration_lines_are_fitted_side_by_side(spark, monkeypatch):
    both = Barrier(2, timeout=60)

    class Waiting(M.LogisticRegression):
        def fit(self, rows):
            both.wait()  # one fit after the other would never meet here
            return super().fit(rows)

    class Heads:
        def transform(self, df):
            return df.select("*", *[array_to_vector(F.array(-F.col("x") * s, F.col("x") * s)).alias(f"_raw{i}") for i, s in enumerate((-1, 1))])

    df = spark.createDataFrame([((i % 20) / 10 - 1.0, float((i % 7 + i % 20) > 12), i % 3) for i in range(120)], "x double, label_index double, fold int")
    monkeypatch.setattr(M, "LogisticRegression", Waiting)
    low, high = M.platt(df, 2, 3, lambda rows: Heads(), 2)
    assert low[0] > 0 and abs(low[0] - high[0]) < 1e-3 and abs(low[1] + high[1]) < 1e-3


def test_machines_of_few_rows_are_fitted_in_one_task(spark, incidents, monkeypatch):
    table, classes = M.index_label(incidents.withColumn("fold", (F.col("incident_id") % 3).cast("int")))
    table = table.repartition(8).persist()
    seen, fit_all = [], M.one_per_class
    monkeypatch.setattr(M, "one_per_class", lambda df, *more: seen.append(df.rdd.getNumPartitions()) or fit_all(df, *more))
    spec, features = M.ModelSpec("SVM", "svm", {}, {"max_iter": 2, "dims": 4}), ["latency", "error_rate"]
    M.fit(table, spec, {"C": 1, "kernel": "rbf"}, features, classes, calibrate=False)
    monkeypatch.setattr(M, "TASK_VALUES", 4 * table.count())
    M.fit(table, spec, {"C": 1, "kernel": "rbf"}, features, classes, calibrate=False)
    monkeypatch.setattr(M, "TASK_VALUES", table.count())
    M.fit(table, spec, {"C": 1, "kernel": "rbf"}, features, classes, calibrate=False)
    monkeypatch.setattr(M, "TASK_VALUES", 1)
    M.fit(table, spec, {"C": 1, "kernel": "linear"}, features, classes, calibrate=False)
    table.unpersist()
    assert seen == [1, 1, 4, 8]
