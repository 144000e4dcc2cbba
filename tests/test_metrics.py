import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from culprit.operators import metrics


def scored(spark, pairs, model="m"):
    return spark.createDataFrame([(model, a, p) for a, p in pairs], "model_name string, actual string, prediction string")


def as_dict(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_unpredicted_class_scores_zero(spark):
    df = scored(spark, [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")])
    report = as_dict(metrics.classification_report(df), "class")
    assert report[("c",)]["precision"] == 0 and report[("c",)]["f1"] == 0 and report[("c",)]["support"] == 1
    assert report[("a",)]["precision"] == 1 and report[("a",)]["recall"] == 0.5
    assert report[("b",)]["precision"] == pytest.approx(1 / 3) and report[("b",)]["recall"] == 1
    assert report[("accuracy",)]["f1"] == 0.5
    assert report[("macro avg",)]["f1"] == pytest.approx((2 / 3 + 0.5 + 0) / 3)
    assert report[("weighted avg",)]["recall"] == pytest.approx(0.5)


def test_class_that_is_only_predicted_counts_in_the_macro_average(spark):
    report = as_dict(metrics.classification_report(scored(spark, [("a", "a"), ("a", "z")])), "class")
    assert report[("z",)]["support"] == 0 and report[("z",)]["recall"] == 0
    assert report[("macro avg",)]["recall"] == 0.25


def test_confusion_matrix_has_zero_cells(spark):
    df = scored(spark, [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")])
    cells = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df).collect()}
    assert len(cells) == 9 and sum(cells.values()) == 4
    assert cells[("a", "b")] == 1 and cells[("c", "c")] == 0
    wide = as_dict(metrics.confusion_wide(df, ["a", "b", "c"]), "actual")
    assert (wide[("a",)]["a"], wide[("a",)]["b"], wide[("a",)]["c"]) == (1, 1, 0)


def test_weighted_f1_equals_mllib(spark):
    rng = random.Random(1)
    pairs = [(rng.choice("abc"), rng.choice("abc")) for _ in range(300)]
    df = scored(spark, pairs)
    ours = as_dict(metrics.classification_report(df), "class")[("weighted avg",)]["f1"]
    indexed = df.select(
        *[F.expr(f"double(ascii({c}) - 97) AS {c}") for c in ("actual", "prediction")]
    )
    theirs = MulticlassClassificationEvaluator(labelCol="actual", predictionCol="prediction", metricName="f1").evaluate(indexed)
    assert ours == pytest.approx(theirs)


def test_best_model_tie_goes_to_registry_order(spark):
    a, b = scored(spark, [("a", "a"), ("b", "b")], "second"), scored(spark, [("a", "a"), ("b", "b")], "first")
    board = metrics.leaderboard(a.unionByName(b), {"first": "p1", "second": "p2"}).collect()
    assert [r["model_name"] for r in board] == ["first", "second"] and board[0]["model_path"] == "p1"


def auc(spark, rows, **kw):
    df = spark.createDataFrame(rows, "g string, s double, y boolean")
    return as_dict(metrics.roc_auc(df, ["g"], "s", "y", **kw), "g")


def test_auc_ties_count_half(spark):
    out = auc(spark, [("g", 1.0, False), ("g", 1.0, True), ("g", 2.0, False), ("g", 2.0, True)])
    assert out[("g",)]["roc_auc"] == 0.5


def test_auc_of_one_class_is_an_error_text(spark):
    out = auc(spark, [("g", 1.0, True), ("g", 2.0, True)])[("g",)]
    assert out["roc_auc"] is None and "one class" in out["roc_auc_error"]


@pytest.mark.parametrize("buckets", [2, 16, 256])
def test_auc_equals_all_pairs(spark, buckets):
    rng = random.Random(buckets)
    # A third of the rows share one score.
    rows = [
        (rng.choice("gh"), 0.5 if rng.random() < 0.33 else round(rng.random(), 3), rng.random() < 0.4)
        for _ in range(600)
    ]
    out = auc(spark, rows, buckets=buckets)
    for g in "gh":
        pos = [s for k, s, y in rows if k == g and y]
        neg = [s for k, s, y in rows if k == g and not y]
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert out[(g,)]["roc_auc"] == pytest.approx(want)


def test_macro_auc_is_null_when_a_class_is_missing(spark):
    df = spark.createDataFrame(
        [("m", "a", [0.8, 0.1, 0.1]), ("m", "b", [0.2, 0.7, 0.1])], "model_name string, actual string, proba array<double>"
    )
    row = metrics.model_auc(df, ["a", "b", "c"]).first()
    assert row["roc_auc"] is None and row["roc_auc_error"]
    binary = spark.createDataFrame(
        [("m", "a", [0.8, 0.2]), ("m", "b", [0.2, 0.8])], "model_name string, actual string, proba array<double>"
    )
    assert metrics.model_auc(binary, ["a", "b"]).first()["roc_auc"] == 1.0


def plain_auc(rows):
    """Share of ordered pairs, ties half; null lies below all scores and NaN above."""
    place = lambda s: (0, 0.0) if s is None else (2, 0.0) if s != s else (1, s + 0.0)
    pos, neg = [place(s) for s, p in rows if p], [place(s) for s, p in rows if not p]
    won = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return won / (len(pos) * len(neg)) if pos and neg else None


def test_auc_with_scores_shared_between_batches_and_ranges(spark):
    draw = random.Random(8)
    odd = [None, float("nan"), 0.0, -0.0, 0.5, float("inf"), -float("inf")]
    rows = [
        (draw.choice(["a", "b", None]), draw.randrange(2), 0.25 if draw.random() < 0.4 else draw.choice([*odd, draw.random()]), draw.choice([True, False, False, None]))
        for _ in range(900)
    ] + [("one", 0, 0.3, True)]
    table = spark.createDataFrame(rows, "m string, c int, s double, p boolean").repartition(7)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (1, 4, 50, 10_000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = {(r.m, r.c): r for r in metrics.roc_auc(table, ["m", "c"], "s", "p", buckets=5).collect()}
            assert len(got) == 7
            for (m, c), r in got.items():
                own = [(s, p) for a, b, s, p in rows if (a, b) == (m, c)]
                assert (r.n_pos, r.n_neg) == (sum(bool(p) for _, p in own), sum(not p for _, p in own))
                assert r.roc_auc == (None if m == "one" else pytest.approx(plain_auc(own), abs=1e-12))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_auc_writes_no_table_of_scores(spark):
    import os

    folder = spark.conf.get("spark.checkpoint.dir")
    held = set(os.listdir(folder))
    table = spark.createDataFrame([(0.1 * i, i % 3 == 0) for i in range(20)], "s double, p boolean")
    assert metrics.roc_auc(table, [], "s", "p").first().n_pos == 7
    assert set(os.listdir(folder)) == held


def test_code_of_several_cards_is_short_enough_to_be_compiled(spark, incidents, capsys):
    import re

    from culprit import fixed_values as V
    from culprit.operators import scoring
    from culprit.operators.scorecard import fixed_scorecards

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        scoring.score_models(fixed_scorecards(), incidents, V.LABEL, "incident_id").explain(mode="codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8_000
