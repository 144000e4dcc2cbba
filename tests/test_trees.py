import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from culprit import fixed_values as V
from culprit.operators import estimators as M
from culprit.operators import explain, splits, trees
from culprit.plans import stages

KEY = "incident_id"


def random_tree(draw, n_features, depth, n_classes, tree):
    """Node rows of a tree with random splits, some of them repeated on a path, and covers that add up."""
    rows, count = [], itertools.count()

    def grow(level):
        node = next(count)
        if level == 0 or (level < depth and draw.random() < 0.2):
            rows.append((tree, node, -1, 0.0, -1, -1, float(draw.integers(1, 20)), draw.normal(size=n_classes).tolist()))
            return node, rows[-1][6]
        feature, threshold = int(draw.integers(n_features)), float(np.round(draw.normal(), 1))
        left, a = grow(level - 1)
        right, b = grow(level - 1)
        rows.append((tree, node, feature, threshold, left, right, a + b, []))
        return node, a + b

    grow(depth)
    return rows


def expected(nodes, x, inside, node=0):
    """Score when the features inside follow the row and the others the cover."""
    _, _, f, threshold, left, right, cover, value = nodes[node]
    if f < 0:
        return np.array(value)
    if f in inside:
        return expected(nodes, x, inside, left if x[f] <= threshold else right)
    share = nodes[left][6] / cover if cover else 0.0
    return share * expected(nodes, x, inside, left) + (1 - share) * expected(nodes, x, inside, right)


def brute(forest, x, m):
    """Shapley values over all subsets, and the value of the empty one."""
    score = lambda s: sum(expected(nodes, x, s) for nodes in forest)
    worth = {s: score(s) for k in range(m + 1) for s in itertools.combinations(range(m), k)}
    phi = np.zeros((m, len(worth[()])))
    for s, v in worth.items():
        for j in range(m):
            if j not in s:
                weight = math.factorial(len(s)) * math.factorial(m - len(s) - 1) / math.factorial(m)
                phi[j] += weight * (worth[tuple(sorted((*s, j)))] - v)
    return phi.T, worth[()]


@pytest.mark.parametrize("m, depth, turn_bytes", [(3, 3, 1 << 20), (5, 6, 1 << 20), (5, 6, 2_000), (1, 2, 1 << 20)])
def test_tree_shap_equals_the_expectation_over_all_subsets(spark, m, depth, turn_bytes):
    draw = np.random.default_rng(depth + m)
    rows = [r for t in range(3) for r in random_tree(draw, m, depth, 2, t)]
    forest = [{r[1]: r for r in rows if r[0] == t} for t in range(3)]
    names = [f"f{j}" for j in range(m)]
    x = np.round(draw.normal(size=(15, m)), 1).tolist()
    x.append([None] * m)
    table = spark.createDataFrame([(i, *v) for i, v in enumerate(x)], "k long, " + ", ".join(f"{n} double" for n in names))
    got = trees.tree_shap(spark.createDataFrame(rows, trees.NODES), table, names, 2, turn_bytes=turn_bytes)
    for r in got.collect():
        values = [math.inf if v is None else v for v in x[r["k"]]]
        phi, base = brute(forest, values, m)
        assert np.abs(np.array(r["phi"]) - phi).max() < 1e-9 and np.abs(np.array(r["base"]) - base).max() < 1e-9
        assert [r[n] for n in names] == x[r["k"]]


def test_splits_without_cover():
    nodes = {
        0: (0, 0, 0, 0.0, 1, 2, 10.0, []),
        1: (0, 1, 1, 0.0, 3, 4, 0.0, []),
        2: (0, 2, -1, 0.0, -1, -1, 10.0, [1.0]),
        3: (0, 3, -1, 0.0, -1, -1, 0.0, [2.0]),
        4: (0, 4, -1, 0.0, -1, -1, 0.0, [3.0]),
    }
    import pandas as pd

    frame = pd.DataFrame(list(nodes.values()), columns=["tree", "node", "feature", "threshold", "left", "right", "cover", "value"])
    leaves = trees.LeafSet(trees._paths_of_tree(2)(frame))
    phi = leaves.contributions(np.array([[1.0, 0.0]]))
    assert np.isfinite(phi).all() and leaves.base()[0] + phi.sum() == pytest.approx(1.0)


@pytest.fixture(scope="module")
def forest(incidents):
    train, classes = stages.training_table(splits.stratified_split(incidents, KEY).filter("split = 'train'").drop("split"), KEY)
    return M.fit(train, M.ModelSpec("Random Forest", "forest", {}), {"n_estimators": 7, "max_depth": 5}, V.SIGNALS, classes)


def test_fitted_forest_equals_brute_force_and_adds_up(spark, incidents, forest):
    rows = incidents.orderBy(KEY).limit(4)
    nodes = [tuple(r) for r in forest.node_table(spark).collect()]
    plain = [{r[1]: r for r in nodes if r[0] == t} for t in range(7)]
    values = {r[KEY]: [float(r[f]) for f in V.SIGNALS] for r in rows.collect()}
    for r in explain.contributions(forest, rows, incidents, KEY).collect():
        phi, base = brute(plain, values[r[KEY]], 9)
        assert np.abs(np.array(r["phi"]) - phi).max() < 1e-9 and np.abs(np.array(r["base"]) - base).max() < 1e-9
        assert np.allclose(np.array(r["base"]) + np.array(r["phi"]).sum(axis=1), r["proba"], atol=1e-9)


def test_forest_explains_the_whole_table(spark, incidents, forest):
    out = explain.contributions(forest, incidents, incidents, KEY)
    gap = F.expr("abs(base[0] + aggregate(phi[0], 0D, (a, v) -> a + v) - proba[0])")
    assert out.agg(F.count("*").alias("n"), F.max(gap).alias("gap")).first()["gap"] < 1e-9
    table = explain.global_importance(forest, incidents, KEY, n=50)
    assert {r["method"] for r in table.collect()} == {"shap_tree"} and table.count() == 9


def test_counted_forest(spark, incidents):
    model = trees.CountedForest.counted(incidents)
    nodes = model.node_table(spark).collect()
    assert all(r["cover"] == 3000 for r in nodes if r["node"] == 0)
    scored = model.with_scores(incidents)
    assert scored.columns == [*incidents.columns, "proba", "prediction"]
    # The mean score over the counted rows is the share of every class.
    means = scored.agg(*[F.avg(F.get("proba", F.lit(i))) for i in range(6)]).first()
    shares = {r[V.LABEL]: r["count"] / 3000 for r in incidents.groupBy(V.LABEL).count().collect()}
    assert list(means) == pytest.approx([shares[c] for c in model.classes])
    phi = explain.contributions(model, incidents.limit(5), incidents, KEY).collect()
    for r in phi:
        assert np.allclose(np.array(r["base"]) + np.array(r["phi"]).sum(axis=1), r["proba"], atol=1e-12)


def test_leaves_without_rows_share_evenly(spark, incidents):
    model = trees.CountedForest.counted(incidents, [{0: ("latency", -1.0, 1, 2)}])
    assert model.shares(0, 1) == [1 / 6] * 6
    assert explain.contributions(model, incidents.limit(2), incidents, KEY).count() == 2


def test_contributions_by_pattern_are_those_of_each_row(monkeypatch):
    draw = np.random.default_rng(9)
    shape = (300, 5)
    split = draw.random(shape) < 0.5
    paths = trees.pd.DataFrame(
        {
            "low": list(np.where(split & (draw.random(shape) < 0.6), draw.normal(-1, 1, shape), -np.inf)),
            "high": list(np.where(split, draw.normal(1, 1, shape), np.inf)),
            "share": list(np.where(split, np.where(draw.random(shape) < 0.05, 0.0, draw.random(shape)), 1.0)),
            "value": list(draw.random((300, 3))),
        }
    )
    leaves, x = trees.LeafSet(paths), draw.normal(size=(2500, 5))
    x[3, 1], x[4, 2] = np.nan, -np.inf
    asked = []
    monkeypatch.setattr(trees.np, "exp", lambda v, exp=np.exp: asked.append(v.size) or exp(v))
    looked_up, work = leaves.contributions(x), sum(asked)
    asked.clear()
    monkeypatch.setattr(trees, "MOST_PATTERNS", 0)
    assert np.abs(looked_up - leaves.contributions(x)).max() < 1e-10
    assert work < sum(asked) / 20
