"""Predictions as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culprit.functions.draws import quoted


def predicted_class(proba: str, classes: list[str]) -> Column:
    """Most likely class of a column of shares; the first one wins ties."""
    names = ", ".join(quoted(c) for c in classes)
    return F.expr(f"element_at(array({names}), int(array_position({proba}, array_max({proba}))))")


def predict(model, df: DataFrame) -> DataFrame:
    """All input columns, ``prediction`` and one ``proba_<class>`` per class.

    A model without probabilities gives no such columns.
    """
    scored = model.with_scores(df)
    if "proba" not in scored.columns:
        return scored
    columns = {f"proba_{c}": F.get("proba", F.lit(i)) for i, c in enumerate(model.classes)}
    return scored.withColumns(columns).drop("proba")


def score_models(models: list, df: DataFrame, label: str, key: str) -> DataFrame:
    """Long table of every model's scores: ``model_name, key, actual, prediction, proba``.

    All models score the same row in one pass; the row is then split into one per model.
    """
    for i, m in enumerate(models):
        df = m.with_scores(df).withColumnsRenamed({"proba": f"_scored_proba{i}", "prediction": f"_scored_prediction{i}"})
    scores = F.array(
        *[
            F.struct(
                F.lit(m.name).alias("model_name"),
                F.col(f"_scored_prediction{i}").alias("prediction"),
                F.col(f"_scored_proba{i}").alias("proba"),
            )
            for i, m in enumerate(models)
        ]
    )
    return df.select(key, F.col(label).alias("actual"), F.inline(scores))
