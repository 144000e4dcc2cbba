"""Random draws as column expressions.

Every draw is a function of (seed, stream name, row key) alone, so a row keeps its
values however the table is partitioned, and a lost task recomputes the same rows.
The hash is Spark's built-in ``xxhash64``: one native call inside generated code. Draws are
given as SQL text with column names in it, which the driver hands over in one piece.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def stream_hash(key: str, stream: str, seed: int) -> str:
    """64-bit hash of a key within one named stream."""
    return f"xxhash64('{seed}|{stream}', `{key}`)"


def shuffle_key(key: str, stream: str, seed: int) -> Column:
    """Non-negative 52-bit value that puts rows in a random but fixed order."""
    return F.expr(f"shiftrightunsigned({stream_hash(key, stream, seed)}, 12)")


def uniform_text(key: str, stream: str, seed: int) -> str:
    return f"((shiftrightunsigned({stream_hash(key, stream, seed)}, 12) + 0.5D) * {2.0**-52!r}D)"


def hash_uniform(key: str, stream: str, seed: int) -> Column:
    """Uniform draw strictly between 0 and 1."""
    return F.expr(uniform_text(key, stream, seed))


def normal_text(key: str, stream: str, seed: int, mean: float = 0.0, std: float = 1.0) -> str:
    h = stream_hash(key, stream, seed)
    u1 = f"(shiftrightunsigned({h}, 32) + 0.5D) * {2.0**-32!r}D"
    u2 = f"(({h} & 4294967295L) + 0.5D) * {2.0**-32!r}D"
    z = f"sqrt(-2D * ln({u1})) * cos({2.0 * math.pi!r}D * ({u2}))"
    return f"({z})" if (mean, std) == (0.0, 1.0) else f"({mean!r}D + {std!r}D * ({z}))"


def hash_normal(key: str, stream: str, seed: int, mean: float = 0.0, std: float = 1.0) -> Column:
    """Normal draw (Box-Muller on the two halves of one hash)."""
    return F.expr(normal_text(key, stream, seed, mean, std))


def hash_poisson(u: str, rate: str, quick: int = 6) -> Column:
    """Poisson count with mean ``rate`` for the uniform draw ``u``, both given as column names.

    Counts below ``quick`` come from closed polynomials that stay in generated code; the
    rare larger ones walk the distribution. ``rate`` must stay below about 700, where
    ``exp(-rate)`` underflows.
    """
    # P(count <= j) = exp(-rate) * (1 + rate + rate^2/2! + ... + rate^j/j!)
    below = []
    for j in range(quick):
        series = "1D"
        for i in range(j, 0, -1):
            series = f"(1D + {rate} * {series} / {float(i)}D)"
        below.append(f"exp(-{rate}) * {series}")
    small = " + ".join(f"int({u} >= {b})" for b in below)
    walked = (
        f"aggregate(sequence(1, int(ceil({rate} + 10D * sqrt({rate}) + 10D))), "
        f"struct(int({u} >= exp(-{rate})) AS n, exp(-{rate}) AS p, exp(-{rate}) AS cdf), "
        f"(acc, j) -> struct(acc.n + int({u} >= acc.cdf + acc.p * {rate} / j) AS n, "
        f"acc.p * {rate} / j AS p, acc.cdf + acc.p * {rate} / j AS cdf), "
        "acc -> acc.n)"
    )
    return F.expr(f"bigint(CASE WHEN {u} < {below[-1]} THEN {small} ELSE {walked} END)")


def weighted_choice(u: str, weights: dict[str, float]) -> Column:
    """Label whose cumulative share is the first one above the draw ``u``, given as text."""
    total = sum(weights.values())
    bound, labels = 0.0, list(weights)
    choice = F.lit(labels[-1])
    hits = []
    for label in labels[:-1]:
        bound += weights[label] / total
        hits.append(f"WHEN {u} < {bound!r}D THEN {quoted(label)}")
    return F.expr(f"CASE {' '.join(hits)} ELSE {quoted(labels[-1])} END") if hits else choice


def quoted(text: str) -> str:
    """A string as an SQL literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
