"""Links of vectors against all pairs."""

import math

import numpy as np
import pandas as pd
import pytest

from culprit.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, node string, cell string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)


def plain(rows):
    unit = []
    for _, v, label in rows:
        ok = v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if ok else None)
    n, group = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98:
                n[i], n[j] = n[i] + 1, n[j] + 1
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(root(i), []).append(r[0])
    comp = [min(ids[root(i)]) for i in range(len(rows))]
    return sorted((r[0], n[i], comp[i], r[0] == comp[i]) for i, r in enumerate(rows))


@pytest.fixture
def rows():
    draw = np.random.default_rng(3)
    centres = draw.standard_normal((12, 16))
    out = []
    for i in range(600):
        v = centres[i % 12] + draw.standard_normal(16) * draw.choice([0.02, 0.1, 0.2, 1.0])
        out.append((i, v.astype(np.float32).tolist(), int(i % 3)))
    return out + [(700 + i, out[0][1], 0) for i in range(40)] + [(800 + i, out[1][1], None) for i in range(3)]


@pytest.mark.parametrize("more", [{}, {"cell_rows": 20, "piece_rows": 16, "fit_rows": 100}, {"cell_rows": 5, "piece_rows": 4}])
def test_links(spark, rows, more):
    got = embedding_dedup.near_duplicates(frame(spark, rows), **more).collect()
    assert sorted(tuple(r) for r in got) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, nan], 0), (5, [inf, 1.0], 0), (6, [1.0, None], 0), (7, [1.0, 0.0], 0)]
    rows += [(8, [2.0, 0.0], 0), (9, [1.0, 0.0, 0.0], 0), (10, [5.0, 0.0, 0.0], 0), (11, [-1.0, 0.0], 0), (12, [1.0, 0.0], 1), (13, [1.0, 0.0], None)]
    got = embedding_dedup.near_duplicates(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == plain(rows)


def test_rows_without_id_and_repeated_rows(spark):
    rows = [(None, [1.0, 0.0], 0), (5, [1.0, 0.0], 0), (5, [1.0, 0.0], 0), (None, [0.0, 1.0], 0)]
    got = embedding_dedup.near_duplicates(frame(spark, rows)).select("vec_id", "n_links", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 2, 5), (5, 2, 5), (5, 2, 5), (None, 0, None)], key=str)


def test_nothing_to_link(spark):
    assert embedding_dedup.near_duplicates(frame(spark, [])).count() == 0
    assert embedding_dedup.near_duplicates(frame(spark, [(1, None, 0)])).collect()[0][:] == (1, 0, 1, True)


def test_placing_holds_small_batches_only():
    """Vectors near the planes of many cells gave one batch of all their copies, more than an executor holds."""
    draw = np.random.default_rng(5)
    x = draw.standard_normal((6000, 48))
    centres = embedding_dedup.fit_cells(x / np.linalg.norm(x, axis=1)[:, None], 400, rounds=1)
    batch = pd.DataFrame({"node": range(6000), "vector": list(x)})
    out = list(embedding_dedup._assigner(centres, 0.98)([batch]))
    assert max(map(len, out)) <= embedding_dedup.BATCH_ROWS and sum(map(len, out)) > 10 * 6000
    own = pd.concat([b for b in out if not b["guest"].any()])
    assert sorted(own["node"]) == list(range(6000))


def test_cells_are_taken_where_they_separate():
    """Vectors all over the sphere would be copied into most cells; clouds far apart are not."""
    draw = np.random.default_rng(5)
    spread = draw.standard_normal((3000, 48))
    clouds = draw.standard_normal((64, 48))[draw.integers(0, 64, 3000)] + 0.01 * draw.standard_normal((3000, 48))
    found = [
        len(embedding_dedup.choose_cells(x / np.linalg.norm(x, axis=1)[:, None], n, 0.1, 64, 0.98, 8_192))
        for x, n in ((spread, 20_000), (clouds, 200_000))
    ]
    assert found[0] == 1 and found[1] >= 16


def test_links_do_not_depend_on_the_cells(spark, rows, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "choose_cells", lambda sample, n, alike, most, *more: embedding_dedup.fit_cells(sample, min(most, 40)))
    got = embedding_dedup.near_duplicates(frame(spark, rows), cell_rows=5, piece_rows=4).collect()
    assert sorted(tuple(r) for r in got) == plain(rows)
