"""The incident table: every signal is a column expression over a keyed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culprit import fixed_values as V
from culprit.functions.draws import (
    hash_normal,
    hash_poisson,
    hash_uniform,
    normal_text,
    uniform_text,
    weighted_choice,
)
from culprit.sources.mixture import check_mixture, mixture_lookup, mixture_rows, read_mixture
from culprit.sources.shared import small

RENAMED = {"avg_cpu": "avg_cpu_usage", "upstream_error": "upstream_error_rate"}


def with_label(
    df: DataFrame,
    key: str,
    seed: int = V.SEED,
    prior: dict[str, float] | None = None,
    label: str = V.LABEL,
) -> DataFrame:
    """Draw the root cause of each row by the given shares."""
    draw = uniform_text(key, "label", seed)
    return df.withColumn(label, weighted_choice(draw, prior or V.ROOT_CAUSE_PRIOR))


def with_baselines(df: DataFrame, key: str, seed: int = V.SEED) -> DataFrame:
    """Draw the healthy level of each signal."""
    return df.withColumns(
        {
            name: hash_normal(key, f"base:{name}", seed, mean, std)
            for name, (mean, std) in V.BASELINES.items()
        }
    )


def with_picks(
    df: DataFrame,
    key: str,
    mixture: DataFrame | None = None,
    seed: int = V.SEED,
    label: str = V.LABEL,
) -> DataFrame:
    """Add ``pick_<signal>``, the number of upper bounds the draw has reached (null past the last),
    and the ``mean_<signal>`` and ``std_<signal>`` of all components.

    The lookup has one row per root cause; it is broadcast once its size is known, so the rows
    stay where they are. ``filter`` on an array also ends whole-stage generation here: the
    projection is then compiled as many small methods, where one method of all draws would
    pass the 8,000 bytes up to which the JVM compiles.
    """
    if mixture is None:
        # The built-in lookup has six rows.
        lookup = F.broadcast(mixture_lookup(read_mixture(df.sparkSession)))
    else:
        check_mixture(mixture)
        lookup = small(mixture_lookup(mixture))
    lookup = lookup.withColumnRenamed("root_cause", label)
    # The draw has a column of its own, so that it is not repeated for every component.
    drawn = df.join(lookup, label, "left").withColumns(
        {f"_u_{n}": hash_uniform(key, f"pick:{n}", seed) for n in V.BASELINES}
    )
    picked = drawn.withColumns(
        {
            f"pick_{n}": F.expr(f"nullif(size(filter(hi_{n}, hi -> hi <= _u_{n})), size(hi_{n}))")
            for n in V.BASELINES
        }
    )
    return picked.drop(*[f"{part}_{n}" for n in V.BASELINES for part in ("hi", "_u")])


def component_usage(
    df: DataFrame,
    key: str,
    mixture: DataFrame | None = None,
    seed: int = V.SEED,
    label: str = V.LABEL,
) -> DataFrame:
    """The flat mixture table with the number of rows that drew each component."""
    mixture = read_mixture(df.sparkSession) if mixture is None else mixture
    picked = with_picks(df, key, mixture, seed, label)
    drawn = F.array(
        *[F.struct(F.lit(n).alias("metric"), F.col(f"pick_{n}").alias("k")) for n in V.BASELINES]
    )
    counts = (
        picked.select(F.col(label).alias("root_cause"), F.inline(drawn))
        .filter(F.col("k").isNotNull())
        .groupBy("root_cause", "metric", "k")
        .agg(F.count("*").alias("n_drawn"))
    )
    table = mixture_rows(mixture).join(counts, ["root_cause", "metric", "k"], "left")
    return table.withColumn("n_drawn", F.coalesce("n_drawn", F.lit(0).cast("long")))


def mixture_totals(
    df: DataFrame, mixture: DataFrame | None = None, label: str = V.LABEL
) -> DataFrame:
    """Sum of the shares per root cause and signal, and how many rows depend on it."""
    mixture = read_mixture(df.sparkSession) if mixture is None else mixture
    totals = mixture_rows(mixture).groupBy("root_cause", "metric").agg(F.sum("p").alias("total"))
    used = df.groupBy(F.col(label).alias("root_cause")).agg(F.count("*").alias("n_rows"))
    return totals.join(used, "root_cause", "left").select(
        "root_cause",
        "metric",
        "total",
        (F.abs(F.col("total") - 1.0) <= 1e-8 + 1e-5).alias("valid"),
        F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"),
    )


def with_mixture_shift(
    df: DataFrame,
    key: str,
    mixture: DataFrame | None = None,
    seed: int = V.SEED,
    label: str = V.LABEL,
) -> DataFrame:
    """Add to each signal a draw from its chosen component; without one it stays as it is."""
    df = with_picks(df, key, mixture, seed, label)
    shifts = {}
    for n in V.BASELINES:
        z = normal_text(key, f"shift:{n}", seed)
        shifts[n] = F.expr(f"{n} + coalesce(get(mean_{n}, pick_{n}) + get(std_{n}, pick_{n}) * {z}, 0D)")
    return df.withColumns(shifts).drop(*[f"{part}_{n}" for n in V.BASELINES for part in ("pick", "mean", "std")])


def with_couplings(df: DataFrame, key: str, seed: int = V.SEED) -> DataFrame:
    """Let the signals pull on each other: requests on CPU, CPU on memory, all on latency."""
    cpu = f"avg_cpu + ({V.CPU_PER_REQUEST}D * request_rate + {normal_text(key, 'noise:avg_cpu', seed, *V.CPU_NOISE)})"
    excess = f"greatest(request_rate - {V.NORMAL_REQUEST_RATE}D, 0D)"
    df = df.withColumns(
        {
            "avg_cpu": F.expr(f"least(greatest({cpu}, 0D), 100D)"),
            "dependency_latency": F.expr(f"dependency_latency + {V.DEPENDENCY_PER_EXCESS_REQUEST}D * {excess}"),
        }
    )
    df = df.withColumn("mem_growth", F.expr(f"mem_growth + {V.MEMORY_PER_CPU}D * avg_cpu"))
    noise = normal_text(key, "noise:latency", seed, *V.LATENCY_NOISE)
    pull = " + ".join([noise, *[f"{weight}D * {name}" for name, weight in V.LATENCY_WEIGHTS.items()]])
    return df.withColumn("latency", F.expr(f"greatest(latency + ({pull}), {V.LATENCY_FLOOR}D)"))


def stress_text() -> str:
    return " + ".join([f"{V.STRESS_BIAS}D", *[f"{weight}D * {name}" for name, weight in V.STRESS_WEIGHTS.items()]])


def stress_score() -> Column:
    return F.expr(stress_text())


def with_stress(df: DataFrame) -> DataFrame:
    """Raise the error rate by the logistic of the stress score (taken before the raise)."""
    return df.withColumn("error_rate", F.expr(f"error_rate + 1D / (1D + exp(-({stress_text()})))"))


def with_log_counts(df: DataFrame, key: str, seed: int = V.SEED) -> DataFrame:
    """Draw log counts from the signals before their final clamps."""
    df = df.withColumns(
        {
            "_rate_oom": F.expr(f"greatest(mem_growth * {V.OOM_PER_MEMORY}D, {V.OOM_FLOOR}D)"),
            "_rate_timeout": F.expr(
                f"greatest(dependency_latency / {V.DEPENDENCY_LATENCY_PER_TIMEOUT}D, {V.TIMEOUT_FLOOR}D)"
            ),
            "_u_oom": hash_uniform(key, "oom", seed),
            "_u_timeout": hash_uniform(key, "timeout", seed),
        }
    )
    counts = {f"{n}_log_count": hash_poisson(f"_u_{n}", f"_rate_{n}") for n in ("oom", "timeout")}
    return df.withColumns(counts).drop("_rate_oom", "_rate_timeout", "_u_oom", "_u_timeout")


def published(df: DataFrame, key: str, label: str = V.LABEL) -> DataFrame:
    """Final clamps, published names and column order."""
    df = df.withColumns(
        {
            "request_rate": F.expr("greatest(request_rate, 0D)"),
            "dependency_latency": F.expr("greatest(dependency_latency, 1D)"),
            "mem_growth": F.expr("greatest(mem_growth, 0D)"),
            "error_rate": F.expr("greatest(error_rate, 0D)"),
        }
    ).withColumnsRenamed(RENAMED)
    return df.select(key, *V.SIGNALS, label)


def spread(keys: DataFrame, key: str) -> DataFrame:
    """Use all cores when the keys come in fewer partitions (one small file, say).

    Only the keys move. Large inputs have more partitions than that and stay where they are.
    """
    cores = keys.sparkSession.sparkContext.defaultParallelism
    return keys if keys.rdd.getNumPartitions() >= cores else keys.repartition(cores, key)


def build_incidents(
    keys: DataFrame,
    key: str = "incident_id",
    mixture: DataFrame | None = None,
    prior: dict[str, float] | None = None,
    seed: int = V.SEED,
    label: str = V.LABEL,
) -> DataFrame:
    """One incident per key. Everything is computed where the key is: no shuffle."""
    df = with_label(spread(keys.select(key), key), key, seed, prior, label)
    df = with_baselines(df, key, seed)
    df = with_mixture_shift(df, key, mixture, seed, label)
    df = with_couplings(df, key, seed)
    df = with_stress(df)
    df = with_log_counts(df, key, seed)
    return published(df, key, label)
