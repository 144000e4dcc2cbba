"""Classification metrics as aggregates.

All of them start from counts of (model, actual, predicted), which Spark pre-aggregates
where the rows are; what is shuffled has at most models x classes x classes rows per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SUMMARY_ROWS = ("accuracy", "macro avg", "weighted avg")


def label_counts(scored: DataFrame, by: str = "model_name", actual: str = "actual", predicted: str = "prediction") -> DataFrame:
    return scored.groupBy(by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(scored: DataFrame, by: str = "model_name", actual: str = "actual", predicted: str = "prediction") -> DataFrame:
    """Count per actual and predicted label, zeros included, labels from both sides."""
    counts = label_counts(scored, by, actual, predicted)
    # At most classes x classes cells per model: they fit in one row.
    cell = F.struct(F.struct("actual", "predicted"), F.col("n"))
    table = counts.groupBy(by).agg(F.map_from_entries(F.collect_list(cell)).alias("cells"))
    pairs = F.map_keys("cells")
    labels = F.array_union(F.transform(pairs, lambda p: p["actual"]), F.transform(pairs, lambda p: p["predicted"]))
    return (
        table.select(by, "cells", labels.alias("labels"))
        .select(by, "cells", "labels", F.explode("labels").alias("actual"))
        .select(by, "cells", "actual", F.explode("labels").alias("predicted"))
        .select(
            by,
            "actual",
            "predicted",
            F.coalesce(
                F.try_element_at("cells", F.struct("actual", "predicted")), F.lit(0).cast("long")
            ).alias("n"),
        )
    )


def confusion_wide(scored: DataFrame, labels: list[str], by: str = "model_name") -> DataFrame:
    """Rows are actual labels, one column per predicted label."""
    counts = label_counts(scored, by)
    return counts.groupBy(by, "actual").agg(
        *[F.sum(F.when(F.col("predicted") == c, F.col("n")).otherwise(0)).alias(c) for c in labels]
    )


def class_scores(scored: DataFrame, by: str = "model_name", actual: str = "actual", predicted: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class; a zero denominator gives 0."""
    counts = label_counts(scored, by, actual, predicted)
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), zero.alias("called"), hit.alias("hits")),
        F.struct(F.col("predicted").alias("class"), zero.alias("support"), F.col("n").alias("called"), zero.alias("hits")),
    )
    sums = (
        counts.select(by, F.inline(sides))
        .groupBy(by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "called", "hits")])
    )

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))

    return sums.select(
        by,
        "class",
        ratio(F.col("hits"), F.col("called")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(F.col("hits") * 2, F.col("called") + F.col("support")).alias("f1"),
        "support",
        "hits",
    )


def averages(per_class: DataFrame, by: str = "model_name") -> DataFrame:
    """Accuracy, macro and weighted averages, one row per model."""
    total = F.sum("support")

    def weighted(name):
        return F.coalesce(F.try_divide(F.sum(F.col(name) * F.col("support")), total), F.lit(0.0))

    names = ("precision", "recall", "f1")
    return per_class.groupBy(by).agg(
        F.coalesce(F.try_divide(F.sum("hits").cast("double"), total), F.lit(0.0)).alias("accuracy"),
        *[F.avg(n).alias(f"macro_{n}") for n in names],
        *[weighted(n).alias(f"weighted_{n}") for n in names],
        total.alias("support"),
    )


def classification_report(scored: DataFrame, by: str = "model_name", actual: str = "actual", predicted: str = "prediction") -> DataFrame:
    """Per-class rows, then accuracy, macro and weighted average."""
    per_class = class_scores(scored, by, actual, predicted)
    avg = averages(per_class, by)
    names = ("precision", "recall", "f1")
    summary = avg.select(
        by,
        F.inline(
            F.array(
                F.struct(F.lit("accuracy").alias("class"), *[F.col("accuracy").alias(n) for n in names], "support"),
                F.struct(F.lit("macro avg").alias("class"), *[F.col(f"macro_{n}").alias(n) for n in names], "support"),
                F.struct(F.lit("weighted avg").alias("class"), *[F.col(f"weighted_{n}").alias(n) for n in names], "support"),
            )
        ),
    )
    return per_class.drop("hits").unionByName(summary)


def model_comparison(scored: DataFrame, by: str = "model_name") -> DataFrame:
    """Accuracy and macro precision, recall and F1 per model, best F1 first."""
    avg = averages(class_scores(scored, by), by)
    return avg.select(by, "accuracy", "macro_precision", "macro_recall", "macro_f1").orderBy(
        F.desc("macro_f1"), by
    )


def unpivot_metrics(table: DataFrame, by: str, values: list[str]) -> DataFrame:
    """Wide metric table to long: ``variable, value``."""
    return table.unpivot([by], values, "variable", "value")


def leaderboard(scored: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Validation accuracy and macro F1 per model, best F1 first.

    ``paths`` maps model names to where they are stored, in registry order, which also
    decides between models of equal F1.
    """
    avg = averages(class_scores(scored))
    return (
        _with_path(avg, paths)
        .orderBy(F.desc("macro_f1"), "_place")
        .select(
            "model_name",
            "model_path",
            F.col("accuracy").alias("val_accuracy"),
            F.col("macro_f1").alias("val_f1_macro"),
        )
    )


def eval_summary(scored: DataFrame, classes: list[str], paths: dict[str, str]) -> DataFrame:
    """Accuracy and ROC-AUC per model, best accuracy first."""
    avg = averages(class_scores(scored)).select("model_name", "accuracy")
    auc = model_auc(scored, classes)
    return (
        _with_path(avg.join(auc, "model_name"), paths)
        .orderBy(F.desc("accuracy"), "_place")
        .select("model_name", "model_path", "accuracy", "roc_auc", "roc_auc_error")
    )


def _with_path(table: DataFrame, paths: dict[str, str]) -> DataFrame:
    names = F.array(*[F.lit(n) for n in paths])
    stored = F.create_map(*[F.lit(x) for pair in paths.items() for x in pair])
    return table.withColumns(
        {
            "model_path": F.try_element_at(stored, F.col("model_name")),
            "_place": F.array_position(names, F.col("model_name")),
        }
    )


RANGE_ROWS = 50_000


def roc_auc(scored: DataFrame, by: list[str], score: str, positive: str, buckets: int | None = None) -> DataFrame:
    """Area under the ROC curve per group: the share of correctly ordered pairs, ties half.

    Rows are dealt by score and a random number, about ``RANGE_ROWS`` a partition, in one shuffle,
    so a score shared by a third of the rows is spread as well. Sorted there, they are summed
    batch by batch: scores inside a batch in one sum, its first and last score, which other
    batches may share, in sums of their own. The few sums are merged by score and ranked.
    No group is sorted in one task, and no limits are fetched to the driver.
    """
    # Adding zero makes one score of 0.0 and -0.0.
    rows = scored.select(
        *by,
        (F.col(score).cast("double") + F.lit(0.0)).alias("_score"),
        F.coalesce(F.col(positive), F.lit(False)).alias("_positive"),
    )
    buckets = buckets or max(16, rows.count() // RANGE_ROWS)
    dealt = rows.withColumn("_salt", F.rand(0)).repartitionByRange(buckets, "_score", "_salt")
    dealt = dealt.drop("_salt").sortWithinPartitions("_score")
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in dealt.dtypes[:-1])
    runs = dealt.mapInArrow(summed_runs, f"{kinds}, _above boolean, _won double, _pos long, _neg long")
    # A run above a score lies between it and the next one.
    runs = runs.groupBy(*by, "_score", "_above").agg(*[F.sum(c).alias(c) for c in ("_won", "_pos", "_neg")])
    lower = F.sum("_neg").over(Window.partitionBy(*by).orderBy("_score", "_above")) - F.col("_neg")
    ties = F.when(F.col("_above"), 0.0).otherwise(F.col("_neg") / 2.0)
    sums = (
        runs.withColumn("_won", F.col("_won") + F.col("_pos").cast("double") * (lower.cast("double") + ties))
        .groupBy(*by)
        .agg(F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"), F.sum("_won").alias("_won"))
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return sums.select(
        *by,
        "n_pos",
        "n_neg",
        F.try_divide("_won", pairs).alias("roc_auc"),
        F.when(pairs == 0, "only one class present: ROC-AUC is not defined").alias("roc_auc_error"),
    )


def summed_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the groups of a batch sorted by score: of its first score, its last, and those between.

    Batches have the groups, ``_score`` and ``_positive``. Those between stand above the first score.
    """
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        *groups, score, positive = batch.columns
        group = np.zeros(n, np.int64)
        for column in groups:
            codes = column.dictionary_encode("encode")
            group = group * (len(codes.dictionary) + 1) + codes.indices.to_numpy(zero_copy_only=False)
            group = np.unique(group, return_inverse=True)[1]
        null, value = score.is_null().to_numpy(zero_copy_only=False), score.to_numpy(zero_copy_only=False)
        fresh = np.ones(n, bool)
        both = np.isnan(value[1:]) & np.isnan(value[:-1])
        fresh[1:] = ~((value[1:] == value[:-1]) | both) | (null[1:] != null[:-1])
        rank = np.cumsum(fresh) - 1
        # 0 the first score, 1 those between, 2 the last
        part = np.where(rank == 0, 0, np.where(rank == rank[-1], 2, 1))
        order = np.lexsort((rank, part, group))
        group, part, rank = group[order], part[order], rank[order]
        pos = positive.to_numpy(zero_copy_only=False)[order].astype(np.int64)
        neg = 1 - pos
        tied = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (rank[1:] != rank[:-1])])
        run = np.r_[True, (group[1:] != group[:-1]) | (part[1:] != part[:-1])]
        starts = np.flatnonzero(run)
        run_of = (np.cumsum(run) - 1)[tied]
        p, q = np.add.reduceat(pos, tied), np.add.reduceat(neg, tied)
        before = np.cumsum(q) - q
        first = np.searchsorted(tied, starts)
        won = np.add.reduceat(p * (before - before[first][run_of] + q / 2.0), first)
        above = part[starts] == 1
        # The score of a run between is that of the batch's first row.
        at = pa.array(np.where(above, 0, order[starts]))
        keys = [column.take(pa.array(order[starts])) for column in groups]
        sums = [pa.array(np.add.reduceat(x, starts)) for x in (pos, neg)]
        names = [*batch.schema.names[:-1], "_above", "_won", "_pos", "_neg"]
        yield pa.RecordBatch.from_arrays([*keys, score.take(at), pa.array(above), pa.array(np.where(above, won, 0.0)), *sums], names)


def roc_auc_per_class(scored: DataFrame, classes: list[str], by: str = "model_name") -> DataFrame:
    """One-vs-rest ROC-AUC of every class."""
    # Classes go by number; their names come back with the few rows of the result.
    scores = F.array(
        *[
            F.struct(F.lit(i).alias("class"), F.get("proba", F.lit(i)).alias("score"), (F.col("actual") == c).alias("positive"))
            for i, c in enumerate(classes)
        ]
    )
    table = roc_auc(scored.select(by, F.inline(scores)), [by, "class"], "score", "positive")
    return table.withColumn("class", F.get(F.array(*[F.lit(c) for c in classes]), F.col("class")))


def model_auc(scored: DataFrame, classes: list[str], by: str = "model_name") -> DataFrame:
    """One figure per model: binary (second class is positive) or macro one-vs-rest.

    If any class cannot be scored the figure is null and the reason stands beside it.
    """
    if len(classes) == 2:
        scored = scored.select(
            by, F.get("proba", F.lit(1)).alias("score"), (F.col("actual") == classes[1]).alias("positive")
        )
        return roc_auc(scored, [by], "score", "positive").drop("n_pos", "n_neg")
    return macro_auc(roc_auc_per_class(scored, classes, by), by)


def macro_auc(per_class: DataFrame, by: str = "model_name") -> DataFrame:
    error = F.min("roc_auc_error")
    return per_class.groupBy(by).agg(
        F.when(error.isNull(), F.avg("roc_auc")).alias("roc_auc"), error.alias("roc_auc_error")
    )


def evaluate(scored: DataFrame, classes: list[str], by: str = "model_name") -> DataFrame:
    """Report, confusion matrix and ROC-AUC as one long table: ``model, part, class, metric, value``."""
    report = classification_report(scored, by).withColumn("support", F.col("support").cast("double"))
    names = ["precision", "recall", "f1", "support"]
    rows = report.unpivot([by, "class"], names, "metric", "value").withColumn("part", F.lit("report"))
    cells = confusion_matrix(scored, by).select(
        by,
        F.lit("confusion").alias("part"),
        F.col("actual").alias("class"),
        F.col("predicted").alias("metric"),
        F.col("n").cast("double").alias("value"),
    )
    auc = model_auc(scored, classes, by).select(
        by,
        F.lit("auc").alias("part"),
        F.lit("all").alias("class"),
        F.coalesce("roc_auc_error", F.lit("roc_auc" if len(classes) == 2 else "roc_auc_ovr_macro")).alias("metric"),
        F.col("roc_auc").alias("value"),
    )
    return rows.unionByName(cells).unionByName(auc).select(by, "part", "class", "metric", "value")
