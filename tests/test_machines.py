import numpy as np
import pytest
from pyspark.sql import functions as F

from culprit import fixed_values as V
from culprit.operators import estimators as M
from culprit.operators import machines as P
from culprit.operators import splits
from culprit.plans import stages

KEY = "incident_id"


@pytest.fixture(scope="module")
def parts(incidents):
    table = splits.stratified_split(incidents, KEY)
    train, classes = stages.training_table(table.filter("split = 'train'").drop("split"), KEY)
    return train, table.filter("split = 'val'").drop("split"), classes


@pytest.fixture(scope="module")
def linear(parts):
    return P.fit_pair_machines(parts[0], {"C": 1, "kernel": "linear"}, V.SIGNALS, parts[2], folds=3)


def values(df):
    rows = df.select("label_index", "fold", *V.SIGNALS).collect()
    return np.array([[float(r[f]) for f in V.SIGNALS] for r in rows]), np.array([r["label_index"] for r in rows]), np.array([r["fold"] for r in rows])


def plain_objective(rows, sign, w, c):
    loss, slope, _ = P.rounded_hinge(sign * (rows @ w))
    gradient = c * rows.T @ (sign * slope) + np.append(w[:-1], 0)
    return c * loss.sum() + (w[:-1] ** 2).sum() / 2, gradient


def test_linear_machines_are_at_the_minimum_of_each_pair(parts, linear):
    x, y, _ = values(parts[0])
    scaled = (x - x.mean(axis=0)) / x.std(axis=0)
    rows = np.concatenate([scaled, np.ones((len(x), 1))], axis=1)
    draw = np.random.default_rng(0)
    for (i, j), w in zip(linear.pairs, linear.weights):
        seen = (y == i) | (y == j)
        sign = np.where(y[seen] == i, 1.0, -1.0)
        best, gradient = plain_objective(rows[seen], sign, w, 1.0)
        assert np.abs(gradient).max() < 1e-3
        for _ in range(5):
            assert plain_objective(rows[seen], sign, w + draw.normal(size=len(w)) * 0.01, 1.0)[0] > best


def test_rounded_hinge_is_the_hinge_away_from_its_corner_and_smooth():
    m = np.linspace(-3, 3, 601)
    loss, slope, _ = P.rounded_hinge(m)
    assert np.abs(loss - np.maximum(0, 1 - m)).max() <= P.ROUNDING[-1] / 4 + 1e-12
    assert np.abs(np.gradient(loss, m)[1:-1] - slope[1:-1]).max() < 0.06


def test_coupling_recovers_consistent_pairs_and_minimises():
    draw = np.random.default_rng(1)
    pairs = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    p = draw.dirichlet(np.ones(4), 50)
    r = np.stack([p[:, i] / (p[:, i] + p[:, j]) for i, j in pairs], axis=1)
    assert np.abs(P.coupled(pairs, r, 4) - p).max() < 1e-6
    loss = lambda q, own: sum(((1 - own[k]) * q[i] - own[k] * q[j]) ** 2 for k, (i, j) in enumerate(pairs))
    r = draw.uniform(0.05, 0.95, (20, 6))
    for own, q in zip(r, P.coupled(pairs, r, 4)):
        assert q.sum() == pytest.approx(1) and (q >= 0).all()
        assert all(loss(q, own) <= loss(d, own) + 1e-12 for d in draw.dirichlet(np.ones(4), 200))
    assert P.coupled([(0, 1)], np.array([[0.3]]), 2).tolist() == [[0.3, 0.7]]


def test_lines_fit_margins_of_unseen_rows(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=900)
    y = (draw.uniform(size=900) > 1 / (1 + np.exp(-2 * x))).astype(int)
    df = spark.createDataFrame([(float(a), int(b), i % 3) for i, (a, b) in enumerate(zip(x, y))], "a double, label_index int, fold int")
    model = P.fit_pair_machines(df, {"C": 1, "kernel": "linear"}, ["a"], ["yes", "no"], folds=3)
    shares = model.shares(model.margins(x[:, None]))[:, 0]
    assert np.abs(shares - 1 / (1 + np.exp(-2 * x))).max() < 0.1
    assert model.votes(np.array([[0.5], [-0.5], [0.0]])).tolist() == [0, 1, 1]


def test_scores_and_coefficients(parts, linear):
    _, val, classes = parts
    scored = linear.with_scores(val)
    assert M.accuracy(linear, val, V.LABEL) > 0.5 and set(scored.columns) == {*val.columns, "proba", "prediction"}
    rows = scored.select("proba", F.aggregate("proba", F.lit(0.0), lambda a, v: a + v).alias("s")).collect()
    assert all(r["s"] == pytest.approx(1) and min(r["proba"]) >= 0 for r in rows)
    assert len(linear.coefficients()) == 15 * 9 and linear.with_scores(val.limit(0)).count() == 0


def test_landmarks_approximate_the_kernel_better_than_random_features(parts):
    train = parts[0]
    x, _, _ = values(train)
    mapping = P.feature_map(train, V.SIGNALS, KEY, "scale", landmarks=256)
    rows = mapping.scaled(x[:500])
    exact = P.kernel(rows, rows, mapping.gamma)
    mapped = mapping(x[:500])
    error = np.sqrt(((mapped @ mapped.T - exact) ** 2).mean())
    draw = np.random.default_rng(V.SEED)
    frequencies, phases = draw.normal(size=(9, 256)) * np.sqrt(2 * mapping.gamma), draw.uniform(0, 2 * np.pi, 256)
    z = np.sqrt(2 / 256) * np.cos(rows @ frequencies + phases)
    assert error < np.sqrt(((z @ z.T - exact) ** 2).mean()) / 2


def test_kernel_machines_separate_a_ring(spark):
    df = spark.range(600).select(F.col("id").alias(KEY)).withColumns(
        {"x": F.sin(F.col(KEY)) * (1 + 2 * (F.col(KEY) % 2)), "y": F.cos(F.col(KEY)) * (1 + 2 * (F.col(KEY) % 2))}
    ).withColumn(V.LABEL, F.when(F.col(KEY) % 2 == 0, "inner").otherwise("outer"))
    train, classes = stages.training_table(df, KEY)
    found = {}
    for kernel in ("linear", "rbf"):
        model = P.fit_pair_machines(train, {"C": 10, "kernel": kernel}, ["x", "y"], classes, KEY, folds=2, landmarks=64)
        found[kernel] = M.accuracy(model, df, V.LABEL)
    assert found["rbf"] > 0.99 and found["linear"] < 0.8
    with pytest.raises(ValueError, match="not available"):
        model.coefficients()


def test_constant_features_and_equal_landmarks(spark):
    df = spark.createDataFrame([(i, 1.0, float(i % 2), i % 2, i % 2) for i in range(20)], "k long, same double, a double, label_index int, fold int")
    model = P.fit_pair_machines(df, {"C": 1, "kernel": "rbf"}, ["same", "a"], ["x", "y"], "k", folds=2)
    assert len(model.mapping.landmarks) == 2
    assert {(r["a"], r["prediction"]) for r in model.with_scores(df).collect()} == {(0.0, "x"), (1.0, "y")}


def test_saved_machines_score_alike(spark, parts, linear, tmp_path):
    from culprit.sources import models as store

    again = store.load_model(spark, store.save_model(linear, str(tmp_path / "SVM_pipeline")))
    rows = parts[1].orderBy(KEY).limit(40)
    scored = [{r[KEY]: (r["prediction"], r["proba"]) for r in m.with_scores(rows).collect()} for m in (linear, again)]
    assert scored[0] == scored[1] and again.coefficients() == linear.coefficients()


def test_large_tables_begin_on_some_rows_and_end_at_the_same_weights(parts):
    mapping = P.feature_map(parts[0], V.SIGNALS)
    rows = parts[0].select(F.col("label_index").cast("int").alias("_y"), F.col("fold").cast("int").alias("_fold"), *[F.col(f).cast("double").alias(f) for f in V.SIGNALS]).persist()
    cold, warm = ([P.Machine((0, 1)), P.Machine((2, 3), 1)] for _ in range(2))
    P.fit_machines(rows, cold, mapping, 1.0, V.SIGNALS)
    P.begin_machines(rows, warm, mapping, 1.0, V.SIGNALS, 500)
    assert all(m.weights is not None for m in warm)
    P.fit_machines(rows, warm, mapping, 1.0, V.SIGNALS)
    for a, b in zip(cold, warm):
        assert np.abs(a.weights - b.weights).max() < 1e-5 and b.steps < a.steps
