"""The stages from keys to explanations. Tables are handed on as DataFrames; files are
written where a stage ends."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culprit import fixed_values as V
from culprit.operators import explain, metrics, scoring, splits
from culprit.operators.estimators import FittedModel, ModelSpec, grid_search, index_label, registry
from culprit.operators.incidents import build_incidents
from culprit.operators.tables import feature_names
from culprit.sources.models import list_models, load_model, model_folder, save_model
from culprit.sources.shared import written
from culprit.sources.tables import read_table, write_document, write_splits, write_table


def build_dataset(
    keys: DataFrame,
    out: str,
    key: str = "incident_id",
    mixture: DataFrame | None = None,
    seed: int = V.SEED,
    label: str = V.LABEL,
    train: str | float = V.TRAIN_SHARE,
    val: str | float = V.VAL_SHARE,
) -> dict:
    """Build the incidents, write them whole and by split; return paths and row counts."""
    spark = keys.sparkSession
    splits.check_shares(train, val)
    raw = write_table(build_incidents(keys, key, mixture, None, seed, label), f"{out}/raw.parquet")
    table = read_table(spark, raw)
    parts = write_splits(splits.stratified_split(table, key, label, seed, train, val), f"{out}/processed")
    stored = spark.read.parquet(parts)
    splits.check_splits(stored)
    counts = {r["split"]: r["n"] for r in splits.split_counts(stored).collect()}
    return {"raw_path": raw, "splits_path": parts, "n_raw": sum(counts.values()), **{f"n_{s}": n for s, n in counts.items()}}


def training_table(train: DataFrame, key: str, label: str = V.LABEL, seed: int = V.SEED, folds: int = V.FOLDS):
    """The train split with ``label_index`` and ``fold``, written once for all fits."""
    indexed, classes = index_label(splits.stratified_folds(train, key, label, seed, folds), label)
    return written(indexed, "training"), classes


def train_and_validate(
    train: DataFrame,
    val: DataFrame,
    out: str,
    key: str = "incident_id",
    label: str = V.LABEL,
    specs: list[ModelSpec] | None = None,
    seed: int = V.SEED,
    folds: int = V.FOLDS,
    parallelism: int = 4,
) -> dict:
    """Search every family's grid, save the best of each, and rank them on the validation rows."""
    features = feature_names(train, label, (key, "split", "fold"))
    table, classes = training_table(train, key, label, seed, folds)
    table = table.persist()
    models, searches, paths = [], [], {}
    for spec in specs or registry():
        model, results = grid_search(table, spec, features, classes, label, folds, seed, parallelism)
        paths[spec.name] = save_model(model, f"{out}/models/{model_folder(spec.name)}")
        models.append(model)
        searches += [{"model_name": spec.name, **r} for r in results]
    table.unpersist()
    scored = written(scoring.score_models(models, val, label, key), "validated")
    board = metrics.leaderboard(scored, paths)
    write_table(board.coalesce(1), f"{out}/metrics/leaderboard_val.csv")
    best = board.first()
    report = metrics.evaluate(scored, classes)
    rows = F.collect_list(F.struct("part", "class", "metric", "value"))
    params = F.create_map(*[F.lit(x) for m in models for x in (m.name, json.dumps(m.params))])
    document = report.groupBy("model_name").agg(rows.alias("val_metrics")).select(
        F.lit(label).alias("label_col"),
        F.lit("val_f1_macro").alias("selection_metric"),
        F.lit(best["model_name"]).alias("best_model"),
        "model_name",
        params[F.col("model_name")].alias("best_params"),
        "val_metrics",
    )
    write_document(document, f"{out}/metrics/train_val_results.json")
    return {
        "models": models,
        "paths": paths,
        "best": best["model_name"],
        "leaderboard": board,
        "report": report,
        "searches": searches,
        "metrics_path": f"{out}/metrics/train_val_results.json",
    }


def load_models(spark: SparkSession, folder: str) -> dict[str, FittedModel]:
    """Every model of a folder by its path."""
    return {path: load_model(spark, path) for path in list_models(spark, folder)}


def evaluate_models(
    models: dict[str, FittedModel],
    df: DataFrame,
    key: str = "incident_id",
    label: str = V.LABEL,
    out: str | None = None,
    summary: bool = True,
) -> tuple[DataFrame, DataFrame | None]:
    """Full metrics of every model and, unless turned off, the accuracy and AUC summary.

    All models score the table in one pass, whose result all metrics share.
    """
    fitted = list(models.values())
    everything = written(scoring.score_models(fitted, df, label, key), "evaluated")
    report = table = None
    for classes in dict.fromkeys(tuple(m.classes) for m in fitted):
        # Models of one set of classes share the columns of their probabilities.
        own = {m.name: p for p, m in models.items() if tuple(m.classes) == classes}
        scored = everything.filter(F.col("model_name").isin(list(own)))
        part = metrics.evaluate(scored, list(classes))
        report = part if report is None else report.unionByName(part)
        if summary:
            part = metrics.eval_summary(scored, list(classes), own)
            table = part if table is None else table.unionByName(part)
    if out:
        rows = F.collect_list(F.struct("part", "class", "metric", "value"))
        document = report.groupBy("model_name").agg(rows.alias("metrics")).withColumn("label_col", F.lit(label))
        write_document(document, f"{out}/evaluation.json")
        if summary:
            write_table(table.coalesce(1), f"{out}/evaluation_summary.csv")
    return report, table


def predict_table(spark: SparkSession, model_path: str, inputs: str, out: str) -> DataFrame:
    """Score a stored table with a stored model and write the predictions."""
    table = scoring.predict(load_model(spark, model_path), read_table(spark, inputs))
    write_table(table, out)
    return table


def explain_models(
    models: dict[str, FittedModel],
    df: DataFrame,
    key: str = "incident_id",
    label: str = V.LABEL,
    out: str | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Global importance of every model, and one summary row each."""
    spark = df.sparkSession
    tables, summary = None, []
    for path, model in models.items():
        start = time.time()
        table = written(explain.global_importance(model, df, key, label, **options), "importance")
        top = [r["feature"] for r in table.orderBy("rank").collect()]
        method = explain.choose_method(model.kind, len(model.classes))
        summary.append((model.name, path, method, round(time.time() - start, 2), top))
        tables = table if tables is None else tables.unionByName(table)
    rows = spark.createDataFrame(
        summary, "model_name string, model_path string, method string, runtime_sec double, top_features array<string>"
    )
    if out:
        tables.write.mode("overwrite").partitionBy("model_name").option("header", True).csv(f"{out}/global_importance")
        write_document(rows.withColumn("label_col", F.lit(label)), f"{out}/explainability_summary.json")
    return tables, rows
