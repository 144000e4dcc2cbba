"""The quality classifier on held-out rows, its trees, and odd rows."""

import random
import zlib

import numpy as np

from culprit.llm import quality

SCHEMA = "doc_id long, text string, score string, row string"


def junk(prose, i):
    draw = random.Random(i)
    kind = draw.randrange(3)
    words = prose(60, i).split()
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in words)
    if kind == 1:
        return " ".join(draw.choice(words[:3]) for _ in range(200))
    return " ".join(w + draw.choice(["###", "$$$", "%%%"]) for w in words)


def test_held_out_rows(spark, prose):
    rows = [(i, prose(80 + i % 50, i) if i % 3 else junk(prose, i), "s", "r") for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(600)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.classify(spark.createDataFrame(rows, SCHEMA), labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out]
    assert len(held) > 100
    assert np.mean([got[i].predicted == (i % 3 > 0) for i in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_given_table(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    marks = dict(labels.select("doc_id", "quality").collect())
    got = quality.classify(spark.read.parquet(f"{folder}/documents.parquet"), labels).filter("held_out").collect()
    right = [r.predicted == marks[r.doc_id] for r in got if r.doc_id in marks]
    assert np.mean(right) > 0.95


def test_odd_rows(spark, prose):
    texts = [None, "", " \n", "x" * 300_000, prose(200_000, 1), "é😀"]
    rows = [(i, t, "s", "r") for i, t in enumerate(texts)] + [(None, "a b", "s", "r"), (2, "again", "s", "r"), (2, "again", "s", "r")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(0, 1), (2, 0), (2, 1), (None, 1), (3, None), (77, 0)], "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    model = quality.fit(docs, labels)
    assert quality.predict(docs, model).columns == ["doc_id", "text", "row", "score", "predicted"]


def test_nothing_to_learn_from_or_to_score(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.classify(empty, labels).collect() == []
    one = quality.classify(spark.createDataFrame([(1, "a", "s", "r")], SCHEMA), labels).collect()
    assert [r.score for r in one] == [0.5]


def test_flat_trees_equal_walking_each_row():
    draw = np.random.default_rng(1)
    x = draw.standard_normal((500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.boost(x, y, trees=30, depth=3)
    walked = []
    for row in x:
        margin = model.base
        for feature, limit, value in zip(model.feature, model.limit, model.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > limit[node])
            margin += value[node - len(feature)]
        walked.append(1 / (1 + np.exp(-margin)))
    assert np.allclose(model.score(x, rows=64), walked)
    assert np.mean((model.score(x) > 0.5) == y) > 0.97
