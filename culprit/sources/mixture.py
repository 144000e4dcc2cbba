"""The mixture configuration: how each root cause shifts each signal."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from culprit.fixed_values import BASELINES, MIXTURE
from culprit.sources.shared import path_exists

DOCUMENT = "map<string,map<string,array<array<string>>>>"


def read_mixture(spark: SparkSession, path: str | None = None) -> DataFrame:
    """One row per root cause: ``root_cause, signals`` with the raw components of each signal.

    Without a path this is the built-in configuration.
    """
    if path is None:
        text = spark.createDataFrame([(json.dumps(MIXTURE),)], "value string")
    elif path_exists(spark, str(path)):
        text = spark.read.text(str(path), wholetext=True)
    else:
        raise FileNotFoundError(f"no mixture configuration at {path}")
    return text.select(F.explode(F.from_json("value", DOCUMENT)).alias("root_cause", "signals"))


def mixture_rows(mixture: DataFrame) -> DataFrame:
    """Flat table: one row per component, with its share of the unit interval [lo, hi)."""
    parts = (
        mixture.select("root_cause", F.explode("signals").alias("metric", "parts"))
        .select("root_cause", "metric", F.posexplode("parts").alias("k", "part"))
        .select("root_cause", "metric", "k", *_component(F.col("part")))
    )
    so_far = Window.partitionBy("root_cause", "metric").orderBy("k")
    hi = F.sum("p").over(so_far)
    return parts.select(
        "root_cause", "metric", "k", "p", "mean", "std", (hi - F.col("p")).alias("lo"), hi.alias("hi")
    )


def check_mixture(mixture: DataFrame) -> None:
    """Raise unless the components of every signal sum to one."""
    sums = (
        mixture_rows(mixture)
        .groupBy("root_cause", "metric")
        .agg(F.sum("p").alias("total"))
    )
    bad = sums.filter(F.abs(F.col("total") - 1.0) > 1e-8 + 1e-5)
    first = bad.orderBy("root_cause", "metric").first()
    if first is not None:
        raise ValueError(
            f"mixture shares of root cause {first['root_cause']}, "
            f"metric {first['metric']} sum to {first['total']}"
        )


def mixture_lookup(mixture: DataFrame) -> DataFrame:
    """One row per root cause with the arrays ``hi_<signal>, mean_<signal>, std_<signal>``."""
    columns = []
    for name in BASELINES:
        parts = f"try_element_at(signals, '{name}')"
        total = f"aggregate(slice({parts}, 1, i + 1), 0D, (t, d) -> t + double(d[0]))"
        columns += [
            F.expr(f"transform({parts}, (c, i) -> {total}) AS hi_{name}"),
            F.expr(f"transform({parts}, c -> from_json(c[1], 'array<double>')[0]) AS mean_{name}"),
            F.expr(f"transform({parts}, c -> from_json(c[1], 'array<double>')[1]) AS std_{name}"),
        ]
    return mixture.select("root_cause", *columns)


def _component(part):
    moments = F.from_json(part[1], "array<double>")
    return (
        part[0].cast("double").alias("p"),
        moments[0].alias("mean"),
        moments[1].alias("std"),
    )
