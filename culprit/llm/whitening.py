"""Embedding whitening: components from the exact characteristic polynomial of the integer scatter.

Vectors become integers, so the scatter matrix is an exact integer matrix that tasks sum in
parts. Its characteristic polynomial is found modulo many primes (Hessenberg form, one prime
a row of a Spark table) and put together by the Chinese remainder theorem. All its roots are
real, so sign variations count the roots beyond any point exactly; bisection isolates the
largest ones to ``ROOT_BITS`` bits, and inverse iteration in long decimals gives the
components. None of this works with the rows: they meet numpy only to be summed and projected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from culprit.llm.common import kept_table

SCALE = 256
COMPONENTS = 4
ROOT_BITS = 256  # relative precision of an eigenvalue
DIGITS = 140  # decimals of the inverse iteration
LIMB = 20  # bits of a part of a large entry; products of parts are exact in doubles
BLOCK_ROWS = 4_096  # 2 ** 12 products of 2 ** 40 stay below 2 ** 53
LONGEST = 2**63 - 1


def integers(vector: str = "embedding", scale: int = SCALE) -> Column:
    """floor(scale * entry) as longs, held at the limits of long; null where the vector is not usable."""
    doubles = F.col(vector).cast("array<double>")
    finite = F.forall(doubles, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    scaled = F.transform(doubles, lambda v: v * F.lit(float(scale)))
    held = F.transform(
        scaled,
        lambda v: F.when(v >= 2.0**63, F.lit(LONGEST)).when(v < -(2.0**63), F.lit(-LONGEST - 1)).otherwise(F.floor(v)).cast("long"),
    )
    return F.when(F.coalesce(finite, F.lit(False)), held)


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def limbs_of(x: np.ndarray) -> list[np.ndarray]:
    """Parts of ``LIMB`` bits, lowest first, the last one signed; small numbers have one part."""
    parts = []
    while len(x) and max(int(x.max()), -int(x.min())) >= 1 << LIMB:
        parts.append((x & ((1 << LIMB) - 1)).astype(np.float64))
        x = x >> LIMB
    return [*parts, x.astype(np.float64)]


def add_products(total: dict[int, np.ndarray], x: np.ndarray) -> None:
    """Add the products of the rows of ``x`` (led by a one) by the power of two they carry."""
    for at in range(0, len(x), BLOCK_ROWS):
        parts = limbs_of(x[at : at + BLOCK_ROWS])
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                exact = (a.T @ b).astype(np.int64).astype(object)
                total[i + j] = total[i + j] + exact if i + j in total else exact


def _partial_products(width: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Products of (1, x) with itself, summed over the task: 1, sums and squares in one table."""
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                x = matrix_of(batch.column("x"), width)
                add_products(total, np.concatenate([np.ones((len(x), 1), np.int64), x], axis=1))
        row, column = np.triu_indices(width + 1)
        for limb, values in total.items():
            found = [Decimal(int(v)) for v in values[row, column]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int32()), pa.array(column, pa.int32()), pa.array([limb] * len(row), pa.int32()), pa.array(found, pa.decimal128(38, 0))],
                names=["i", "j", "limb", "value"],
            )

    return sums


def exact_sums(fit: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """Rows, sums per dimension and sums of products of the vectors ``x``, all exact.

    A task returns its part of the (width + 1) squared table, so what comes to the driver
    grows with the number of dimensions only.
    """
    parts = fit.select("x").mapInArrow(_partial_products(width), "i int, j int, limb int, value decimal(38,0)")
    found = np.zeros((width + 1, width + 1), dtype=object)
    for r in parts.groupBy("i", "j", "limb").agg(F.sum("value").alias("value")).collect():
        found[r["i"], r["j"]] += int(r["value"]) << (LIMB * r["limb"])
    found = np.triu(found) + np.triu(found, 1).T
    return int(found[0, 0]), [int(v) for v in found[0, 1:]], found[1:, 1:]


def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top`` (at most 2 ** 31, where these bases decide)."""

    def prime(n: int) -> bool:
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            x = pow(base, odd, n)
            if x in (1, n - 1):
                continue
            for _ in range(twos - 1):
                x = x * x % n
                if x == n - 1:
                    break
            else:
                return False
        return True

    out, n = [], top - 1 - top % 2
    while len(out) < count:
        if prime(n):
            out.append(n)
        n -= 2
    return out


def polynomial_modulo(m: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - m) modulo a prime, highest power first, by the Hessenberg form."""
    a = np.array(m % p, dtype=np.int64)
    d = len(a)
    for k in range(d - 2):
        below = np.flatnonzero(a[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            a[[k + 1, pivot]] = a[[pivot, k + 1]]
            a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        factor = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :] = (a[k + 2 :] - factor[:, None] * a[k + 1][None, :] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * factor[None, :] % p).sum(axis=1)) % p
    found = [np.array([1], dtype=np.int64)]  # lowest power first, of the leading k x k part
    for k in range(d):
        nxt = np.zeros(k + 2, dtype=np.int64)
        nxt[1:] = found[k]
        nxt[:-1] = (nxt[:-1] - a[k, k] * found[k] % p) % p
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(a[i + 1, i]) % p
            if chain == 0:
                break
            nxt[: i + 1] = (nxt[: i + 1] - int(a[i, k]) * chain % p * found[i] % p) % p
        found.append(nxt)
    return [int(c) for c in found[d][::-1]]


def characteristic(spark: SparkSession, m: np.ndarray) -> list[int]:
    """Exact coefficients of det(x - m) for a positive semi-definite integer matrix, highest power first.

    The primes are the rows of a Spark table. Their number follows from Maclaurin's bound on
    the coefficients; one further prime confirms the result.
    """
    d, trace = len(m), int(np.trace(m))
    bound = max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))
    primes = primes_below(1 << 31, (2 * bound).bit_length() // 30 + 2)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [polynomial_modulo(m, int(p)) for p in rows["p"]]
            yield pd.DataFrame({"p": rows["p"], "c": found})

    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    table = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    by_prime = {r["p"]: r["c"] for r in table.mapInPandas(solve, "p long, c array<long>").collect()}
    *used, extra = primes
    whole = math.prod(used)
    parts = [whole // p * pow(whole // p, -1, p) for p in used]
    out = []
    for k in range(d + 1):
        c = sum(by_prime[p][k] * part for p, part in zip(used, parts)) % whole
        out.append(c - whole if c > whole // 2 else c)
    if any(c % extra != r for c, r in zip(out, by_prime[extra])):
        raise ArithmeticError("the characteristic polynomial does not agree with a further prime")
    return out


def roots_beyond(c: list[int], a: int, bits: int) -> int:
    """How many roots exceed a / 2 ** bits: sign variations of the shifted polynomial (Descartes).

    The count is exact because all roots are real; a multiple root counts as often as it occurs.
    """
    d = len(c) - 1
    if a:
        shifted = [v * a ** (d - k) << (bits * k) for k, v in enumerate(c)]
        for i in range(d):
            shifted[: d + 1 - i] = accumulate(shifted[: d + 1 - i])
    else:
        shifted = c
    signs = [v > 0 for v in shifted if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def sign_at(c: list[int], a: int, bits: int) -> int:
    """Sign of the polynomial at a / 2 ** bits."""
    total = 0
    for k, v in enumerate(c):
        total = total * a + (v << (bits * k))
    return (total > 0) - (total < 0)


@dataclass(frozen=True)
class Root:
    """Roots between ``low`` (excluded) and ``high``, both over 2 ** bits: the ``first``-th largest and the next ones."""

    low: int
    high: int
    bits: int
    first: int
    times: int


def largest_roots(c: list[int], count: int, precision: int = ROOT_BITS) -> list[Root]:
    """Isolating intervals of the ``count`` largest roots above zero, ``precision`` bits each.

    Bisection by exact counts until an interval holds one root, by signs from there on.
    Roots that agree in all those bits are one multiple root.
    """
    top = abs(c[1]) + 1  # above the sum of the roots, of which none is below zero
    positive = roots_beyond(c, 0, 0)
    out: list[Root] = []
    while (k := sum(r.times for r in out) + 1) <= min(count, positive):
        low, high, bits = 0, top, 0
        above_low, above_high = positive, 0
        while not low or (high - low) << precision > low:
            if high - low <= 1:
                low, high, bits = low << 32, high << 32, bits + 32
            middle = (low + high) // 2
            if above_low - above_high == 1 and low:
                # One root inside: the sign at the upper end holds until the root is passed.
                if sign_at(c, middle, bits) == -((-1) ** above_high):
                    low = middle
                else:
                    high = middle
                continue
            n = roots_beyond(c, middle, bits)
            if n >= k:
                low, above_low = middle, n
            else:
                high, above_high = middle, n
        out.append(Root(low, high, bits, above_high + 1, above_low - above_high))
    return out


def decimal_of(a: int, bits: int) -> Decimal:
    return Decimal(a) / Decimal(2) ** bits


def null_space(m: np.ndarray, root: Root) -> list[list[Decimal]]:
    """Orthonormal vectors of the eigenvalue in ``root``, by inverse iteration from fixed starts."""
    d = len(m)
    value = decimal_of(root.low + root.high, root.bits + 1)
    rows = [[Decimal(int(m[i, j])) - (value if i == j else 0) for j in range(d)] for i in range(d)]
    order, tiny = list(range(d)), abs(value or 1) * Decimal(10) ** (3 - DIGITS)
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(rows[i][k]))
        rows[k], rows[best], order[k], order[best] = rows[best], rows[k], order[best], order[k]
        pivot = rows[k]
        if abs(pivot[k]) < tiny:
            pivot[k] = tiny
        for i in range(k + 1, d):
            row = rows[i]
            if row[k]:
                f = row[k] / pivot[k]
                row[k + 1 :] = [a - f * b for a, b in zip(row[k + 1 :], pivot[k + 1 :])]
                row[k] = f

    def solve(b: list[Decimal]) -> list[Decimal]:
        y = [b[i] for i in order]
        for i in range(d):
            y[i] -= sum((a * v for a, v in zip(rows[i][:i], y[:i])), Decimal(0))
        for i in range(d - 1, -1, -1):
            y[i] = (y[i] - sum((a * v for a, v in zip(rows[i][i + 1 :], y[i + 1 :])), Decimal(0))) / rows[i][i]
        return y

    # Fixed starts in general position: fractional parts of multiples of the golden ratio.
    golden = (Decimal(5).sqrt() - 1) / 2
    basis = [[(golden * (1 + i + d * j)) % 1 - Decimal("0.5") for i in range(d)] for j in range(root.times)]
    for _ in range(3):
        fresh: list[list[Decimal]] = []
        for y in map(solve, basis):
            for _ in range(2):  # twice, so that what is left is orthogonal to the last digit
                for u in fresh:
                    dot = sum(a * b for a, b in zip(u, y))
                    y = [a - dot * b for a, b in zip(y, u)]
                size = sum(a * a for a in y).sqrt()
                y = [a / size for a in y]
            fresh.append(y)
        basis = fresh
    return basis


@dataclass(frozen=True)
class Whitening:
    """Components of the vectors of one width; ``values`` are eigenvalues of the covariance."""

    width: int
    n: int
    sums: list[int]
    values: list[float]
    shares: list[float | None]
    vectors: np.ndarray  # width x components

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates; NaN for a component without variance."""
        mean = np.array([s / self.n for s in self.sums])
        scale = np.array([math.sqrt(v) if v > 0 else math.nan for v in self.values])
        return (x.astype(np.float64) - mean) @ self.vectors / scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S) ** 2, exact; None beyond the range of long."""
        largest = max(int(x.max()), -int(x.min()), 0) if x.size else 0
        if (self.n * largest + max(map(abs, self.sums), default=0)) ** 2 * self.width <= LONGEST:
            gap = self.n * x - np.array(self.sums, dtype=np.int64)
            return (gap * gap).sum(axis=1).tolist()
        gap = self.n * x.astype(object) - np.array(self.sums, dtype=object)
        return [v if v <= LONGEST else None for v in map(int, (gap * gap).sum(axis=1))]


def components_of(spark: SparkSession, n: int, sums: list[int], squares: np.ndarray, count: int = COMPONENTS) -> Whitening:
    """The leading components of vectors with these exact sums."""
    width = len(sums)
    count = min(count, width)
    s = np.array(sums, dtype=object)
    m = n * squares - s[:, None] * s[None, :]  # n ** 2 times the covariance
    trace = int(np.trace(m)) if width else 0
    roots = largest_roots(characteristic(spark, m), count) if trace else []
    values, shares, vectors = [], [], []
    with localcontext() as context:
        context.prec = DIGITS
        for root in roots:
            value = decimal_of(root.low + root.high, root.bits + 1)
            for vector in null_space(m, root)[: count - len(vectors)]:
                lead = max(range(width), key=lambda i: abs(vector[i]))
                sign = 1 if vector[lead] > 0 else -1
                vectors.append([float(sign * v) for v in vector])
                values.append(float(value / Decimal(n) ** 2))
                shares.append(float(value / trace))
        if len(vectors) < count and trace:
            for vector in null_space(m, Root(0, 0, 0, len(vectors) + 1, count - len(vectors))):
                vectors.append([float(v) for v in vector])
                values.append(0.0)
                shares.append(0.0)
    while len(vectors) < count:  # no variance at all: any orthonormal vectors are components
        vectors.append([float(i == len(vectors)) for i in range(width)])
        values.append(0.0)
        shares.append(None)
    return Whitening(width, n, sums, values, shares, np.array(vectors, dtype=np.float64).reshape(count, width).T)


def _projected(model: Whitening):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = model.project(matrix_of(batch.column("x"), model.width))
            columns = [pa.array(w[:, k], pa.float64(), mask=np.isnan(w[:, k])) for k in range(w.shape[1])]
            yield pa.RecordBatch.from_arrays(columns, names=[f"w{k}" for k in range(w.shape[1])])

    return project


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, over the fit list.

    Measured on the vectors themselves; components without variance are left out.
    """
    live = [k for k, v in enumerate(model.values) if v > 0]
    if not live:
        return 0.0
    names = [f"w{k}" for k in range(len(model.values))]
    w = fit.select("x").mapInArrow(_projected(model), ", ".join(f"{c} double" for c in names))
    pairs = [(i, j) for i in live for j in live if i <= j]
    found = w.agg(*[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def _whitened(model: Whitening, error: float, columns: list[str]):
    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column("x"), model.width)
            at = pa.array(np.repeat(np.arange(len(x)), k))
            w = model.project(x).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(at),
                    pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(x) * k, model.n), pa.int64()),
                    pa.array(model.deviations(x), pa.int64()).take(at),
                    pa.array(w, pa.float64(), mask=np.isnan(w)),
                    pa.array(model.shares * len(x), pa.float64()),
                    pa.array(np.full(len(x) * k, error), pa.float64()),
                ],
                names=columns,
            )

    return whiten


def whiten(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, components: int = COMPONENTS
) -> tuple[DataFrame, list[Whitening]]:
    """Whitened coordinates of every vector, and the fitted components per vector width.

    Columns ``vec_id, component, n, deviation, whitened, explained, identity_error``: one row
    per usable row and component. Entries become ``floor(scale * entry)``; every distinct
    integer vector is in the fit list once, so copies weigh nothing. One shuffle finds the
    distinct vectors; sums, the error and the projection are scans.

    Rows whose vector is null or holds a null or non-finite entry are dropped, and an empty
    vector has no components. Entries beyond the range of long are held at its limits; a
    deviation beyond it is null. Vectors of each width are a space of their own. A component
    without variance has ``whitened`` null and ``explained`` 0, or null where nothing varies
    at all. Rows that repeat an id, and null ids, are rows like any other; the key keeps its
    type. An empty table gives no rows. Other columns are not read.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("vec_id"), integers(vector, scale).alias("x")).filter("size(x) > 0")
    fit = kept_table(rows.select("x").distinct(), "fit-vectors")
    kind = dict(rows.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    widths = sorted(r["w"] for r in fit.select(F.size("x").alias("w")).distinct().collect())
    out, models = None, []
    for width in widths:
        own = F.size("x") == width
        model = components_of(spark, *exact_sums(fit.filter(own), width), components)
        error = identity_error(fit.filter(own), model)
        part = rows.filter(own).mapInArrow(_whitened(model, error, columns), schema)
        out = part if out is None else out.unionByName(part)
        models.append(model)
    return (spark.createDataFrame([], schema) if out is None else out), models
