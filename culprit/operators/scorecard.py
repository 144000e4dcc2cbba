"""A linear classifier with given weights, scored in column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culprit import fixed_values as V
from culprit.operators.scoring import predicted_class


class Scorecard:
    """Softmax over one linear score per class."""

    kind = "linear"

    def __init__(self, name: str, classes: list[str], features: list[str], intercepts, weights):
        self.name = name
        self.classes = list(classes)
        self.features = list(features)
        self.intercepts = list(intercepts)
        self.weights = [list(w) for w in weights]

    @classmethod
    def fixed(cls, name: str = "All signals", keep: Iterable[str] = V.SIGNALS) -> Scorecard:
        """The fixed weights; signals outside ``keep`` get weight 0."""
        keep = set(keep)
        classes = sorted(V.SCORECARD)
        weights = [
            [w if f in keep else 0.0 for f, w in zip(V.SIGNALS, V.SCORECARD[c][1])] for c in classes
        ]
        return cls(name, classes, V.SIGNALS, [V.SCORECARD[c][0] for c in classes], weights)

    def margins(self) -> list[str]:
        """Linear score of each class, as SQL text."""
        return [
            " + ".join([f"{float(b)!r}D", *[f"{float(w)!r}D * `{f}`" for f, w in zip(self.features, row)]])
            for b, row in zip(self.intercepts, self.weights)
        ]

    def with_scores(self, df: DataFrame) -> DataFrame:
        """Add ``proba`` (one share per class, in class order) and ``prediction``."""
        n = range(len(self.classes))
        df = df.withColumns({f"_m{i}": F.expr(m) for i, m in enumerate(self.margins())})
        df = df.withColumn("_top", F.expr(f"greatest({', '.join(f'_m{i}' for i in n)})"))
        df = df.withColumns({f"_e{i}": F.expr(f"exp(_m{i} - _top)") for i in n})
        df = df.withColumn("_total", F.expr(" + ".join(f"_e{i}" for i in n)))
        # A lambda is outside whole-stage code, so the code of several cards in a row does not
        # become one method, too long to be compiled.
        parts = ", ".join(f"_e{i}" for i in n)
        df = df.withColumn("proba", F.expr(f"transform(array({parts}), e -> e / _total)"))
        df = df.withColumn("prediction", predicted_class("proba", self.classes))
        return df.drop("_top", "_total", *[f"_{part}{i}" for i in n for part in ("m", "e")])


def fixed_scorecards() -> list[Scorecard]:
    """The full card and two that look at a part of the signals only."""
    return [
        Scorecard.fixed(),
        Scorecard.fixed("Errors and latency", ["error_rate", "latency", "upstream_error_rate", "dependency_latency"]),
        Scorecard.fixed("Load and memory", ["avg_cpu_usage", "mem_growth", "request_rate"]),
    ]
