import math
from fractions import Fraction

import numpy as np
import pytest

from culprit.llm import whitening as W


def table(spark, vectors, extra=""):
    rows = [(i, v) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.selectExpr("*", *([extra] if extra else []))


def plain_polynomial(m):
    """Coefficients of det(x - m) by Faddeev and LeVerrier, in exact integers."""
    d = len(m)
    out, acc = [1], np.zeros((d, d), dtype=object)
    eye = np.array([[int(i == j) for j in range(d)] for i in range(d)], dtype=object)
    for k in range(1, d + 1):
        acc = m.dot(acc) + out[-1] * eye
        out.append(-int(np.trace(m.dot(acc))) // k)
    return out


def scatter(x):
    x = np.array(x, dtype=object)
    s = x.sum(axis=0)
    return len(x) * x.T.dot(x) - s[:, None] * s[None, :]


@pytest.mark.parametrize("d, rows", [(1, 5), (2, 9), (6, 40), (6, 3), (9, 30)])
def test_polynomial_is_exact(spark, d, rows):
    m = scatter(np.random.default_rng(d).integers(-500, 500, (rows, d)).tolist())
    assert W.characteristic(spark, m) == plain_polynomial(m)


def test_roots_are_counted_and_isolated():
    c = [1]
    for r in (7, 7, 7, 4, 1, 0, 0):
        c = [a - r * b for a, b in zip([*c, 0], [0, *c])]
    assert [W.roots_beyond(c, 2 * a, 1) for a in (0, 1, 4, 6, 7, 8)] == [5, 4, 3, 3, 0, 0]
    assert W.roots_beyond(c, 13, 1) == 3
    roots = W.largest_roots(c, 6)
    assert [(r.first, r.times) for r in roots] == [(1, 3), (4, 1), (5, 1)]
    for root, value in zip(roots, (7, 4, 1)):
        low, high = Fraction(root.low, 2**root.bits), Fraction(root.high, 2**root.bits)
        assert low < value <= high and high - low <= Fraction(value, 2**W.ROOT_BITS)


def check(out, models, vectors, scale=256):
    """All columns against exact sums and a plain eigenvalue solver."""
    x = np.array([[math.floor(scale * float(v)) for v in vector] for vector in vectors], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(4, x.shape[1])
    got = {(r["vec_id"], r["component"]): r for r in out.collect()}
    assert set(got) == {(i, c + 1) for i in range(len(x)) for c in range(k)}
    (model,) = models
    assert np.abs(np.abs((model.vectors * axes[:, :k]).sum(axis=0)) - 1).max() < 1e-9
    for i, row in enumerate(x):
        for c in range(k):
            r = got[i, c + 1]
            assert r["n"] == n and r["deviation"] == ((n * row - s) ** 2).sum()
            expected = (row - s / n) @ model.vectors[:, c] / math.sqrt(values[c])
            assert r["whitened"] == pytest.approx(expected, rel=1e-8, abs=1e-8)
            assert r["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-6)
            assert r["identity_error"] < 1e-9


def test_equals_a_plain_solver(spark):
    draw = np.random.default_rng(2)
    vectors = (draw.normal(size=(60, 7)) * [3, 2, 1.5, 1, 0.5, 0.3, 0.1]).tolist()
    vectors += vectors[:20]
    check(*W.whiten(table(spark, vectors, "1 AS x")), vectors)


def test_fewer_dimensions_than_components(spark):
    vectors = [[0.5, 1.0], [0.25, -1.0], [1.5, 0.25], [-2.0, 0.75]]
    check(*W.whiten(table(spark, vectors)), vectors)


def test_multiple_eigenvalues_and_components_without_variance(spark):
    # A cross: three equal variances, and a fourth dimension that never changes.
    vectors = [[s if i == j else 0.0 for j in range(3)] + [1.0] for i in range(3) for s in (1.0, -1.0)]
    out, (model,) = W.whiten(table(spark, vectors))
    assert np.allclose(model.vectors.T @ model.vectors, np.eye(4), atol=1e-14)
    assert model.values[:3] == [model.values[0]] * 3 and model.values[3] == 0.0
    rows = out.collect()
    assert all((r["whitened"] is None) == (r["component"] == 4) for r in rows)
    assert max(r["identity_error"] for r in rows) < 1e-12
    assert [r["explained"] for r in sorted(rows)[:4]] == pytest.approx([1 / 3, 1 / 3, 1 / 3, 0])


def test_near_equal_eigenvalues_are_told_apart(spark):
    big = float(1 << 40)
    vectors = [[big, 0.0], [-big, 0.0], [0.0, big + 1], [0.0, -big - 1]]
    _, (model,) = W.whiten(table(spark, vectors), scale=1)
    assert np.abs(np.abs(model.vectors) - [[0, 1], [1, 0]]).max() < 1e-15


def test_odd_vectors(spark):
    vectors = [None, [], [1.0, None], [1.0, float("nan")], [1.0, float("inf")], [1e300, -1e300], [1.0, 2.0], [3.0, 5.0], [1.0], [4.0]]
    out, models = W.whiten(table(spark, vectors))
    rows = out.collect()
    assert {r["vec_id"] for r in rows} == {5, 6, 7, 8, 9}
    assert [m.width for m in models] == [1, 2] and [m.n for m in models] == [2, 3]
    assert {r["deviation"] for r in rows if r["vec_id"] == 5} == {None}


def test_one_vector_only(spark):
    rows = W.whiten(table(spark, [[1.0, 2.0]] * 3))[0].collect()
    assert len(rows) == 6 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in rows} == {(1, 0, None, None, 0.0)}


def test_empty_table_and_string_keys(spark):
    assert W.whiten(table(spark, []))[0].count() == 0
    df = spark.createDataFrame([("a", [1.0, 0.0]), (None, [0.0, 1.0])], "vec_id string, embedding array<float>")
    assert {r["vec_id"] for r in W.whiten(df)[0].collect()} == {"a", None}


def test_parts_of_large_entries_add_up():
    draw = np.random.default_rng(0)
    x = draw.integers(-(2**62), 2**62, (9, 3))
    total = {}
    W.add_products(total, x)
    found = sum(v * (1 << (W.LIMB * k)) for k, v in total.items())
    assert (found == x.astype(object).T.dot(x.astype(object))).all()
