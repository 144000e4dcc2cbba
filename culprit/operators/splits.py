"""Exact stratified splits, folds and samples without moving the table.

Rows are put in a random but fixed order by a hash of their key. A split is then a cut of
that order: the rows of a class up to the n-th go to the first part, and so on. The cut
values are found from counts per hash bucket, so only the buckets a cut falls into are
sorted, and the table itself gets its split by comparing against a few broadcast values.
No class, however large, is gathered in one task.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from culprit import fixed_values as V
from culprit.functions.draws import shuffle_key
from culprit.sources.shared import small

BUCKETS = 4096


def check_shares(train: str | float, val: str | float) -> Fraction:
    """Both shares in (0, 1) and something left for the evaluation part, which is returned."""
    train, val = Fraction(str(train)), Fraction(str(val))
    if not 0 < train < 1:
        raise ValueError(f"train share must be between 0 and 1, not {float(train)}")
    if not 0 < val < 1:
        raise ValueError(f"validation share must be between 0 and 1, not {float(val)}")
    if train + val >= 1:
        raise ValueError("train and validation shares must sum to less than 1")
    return 1 - train - val


def stratified_split(
    df: DataFrame,
    key: str,
    label: str = V.LABEL,
    seed: int = V.SEED,
    train: str | float = V.TRAIN_SHARE,
    val: str | float = V.VAL_SHARE,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Add ``split`` = train / val / eval with the shares kept inside every class."""
    rest = check_shares(train, val)
    shares = [Fraction(str(train)), Fraction(str(val)), rest]
    part = _with_part(df, key, label, shares, "split", seed, buckets)
    name = F.element_at(F.array(*[F.lit(n) for n in ("train", "val", "eval")]), F.col("_part") + 1)
    return part.withColumn("split", name).drop("_part")


def stratified_holdout(
    df: DataFrame,
    key: str,
    label: str = V.LABEL,
    seed: int = V.SEED,
    test: str | float = V.HOLDOUT_SHARE,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Add ``split`` = train / test."""
    share = Fraction(str(test))
    if not 0 < share < 1:
        raise ValueError(f"test share must be between 0 and 1, not {float(share)}")
    part = _with_part(df, key, label, [1 - share, share], "holdout", seed, buckets)
    return part.withColumn("split", F.when(F.col("_part") == 0, "train").otherwise("test")).drop("_part")


def stratified_folds(
    df: DataFrame,
    key: str,
    label: str = V.LABEL,
    seed: int = V.SEED,
    folds: int = V.FOLDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Add ``fold`` = 0 .. folds-1, every class spread evenly."""
    if folds < 2:
        raise ValueError(f"at least 2 folds are needed, not {folds}")
    part = _with_part(df, key, label, [Fraction(1, folds)] * folds, "fold", seed, buckets)
    return part.withColumnRenamed("_part", "fold")


def quotas(counts: DataFrame, label: str, shares: list[Fraction]) -> DataFrame:
    """Rows of each class up to the end of each part but the last: ``cut_0, cut_1, ..``.

    ``counts`` has one row per class with its ``n``. Part sizes are whole numbers of all
    rows; within a part the classes get their proportional share, and the rows left over
    by rounding down go to the largest remainders, then by class name.
    """
    everything = Window.partitionBy()
    table = counts.withColumns({"_rest": F.col("n"), "_cut": F.lit(0).cast("long")})
    left = sum(shares)
    for i, share in enumerate(shares[:-1]):
        of_rest = share / left
        left -= share
        table = table.withColumn("_total", F.sum("_rest").over(everything))
        product = f"cast(_total AS decimal(19,0)) * cast('{of_rest.numerator}' AS decimal(19,0))"
        table = table.withColumn("_size", F.expr(f"{product} div cast('{of_rest.denominator}' AS decimal(19,0))"))
        exact = F.col("_rest").cast("decimal(19,0)") * F.col("_size").cast("decimal(19,0)")
        table = table.withColumn("_exact", exact)
        table = table.withColumns(
            {
                "_base": F.expr("coalesce(_exact div nullif(_total, 0L), 0L)"),
                "_remainder": F.expr("coalesce(_exact % nullif(_total, 0L), 0L)"),
            }
        )
        place = F.row_number().over(Window.orderBy(F.desc("_remainder"), F.asc(label)))
        extra = F.col("_size") - F.sum("_base").over(everything)
        table = table.withColumn("_quota", F.col("_base") + (place <= extra).cast("long"))
        table = table.withColumns(
            {"_rest": F.col("_rest") - F.col("_quota"), "_cut": F.col("_cut") + F.col("_quota")}
        ).withColumn(f"cut_{i}", F.col("_cut"))
    return table.select(label, *[f"cut_{i}" for i in range(len(shares) - 1)])


def _with_part(
    df: DataFrame, key: str, label: str, shares: list[Fraction], stream: str, seed: int, buckets: int
) -> DataFrame:
    """Add ``_part``. Null labels are a class of their own; equal keys share a part."""
    n_cuts = len(shares) - 1
    order = shuffle_key(key, stream, seed)
    whole, df = df, df.withColumn("_class", F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("")))
    label = "_class"
    rows = df.select(label, F.col(key).alias("_key"), order.alias("_order"))
    rows = rows.withColumn("_bucket", _bucket(F.col("_order"), buckets))
    per_bucket = small(rows.groupBy(label, "_bucket").agg(F.count("*").alias("n")))
    upto = F.sum("n").over(Window.partitionBy(label).orderBy("_bucket"))
    per_bucket = per_bucket.withColumn("_upto", upto)
    cuts = quotas(per_bucket.groupBy(label).agg(F.sum("n").alias("n")), label, shares)
    cuts = cuts.select(
        label,
        F.posexplode(F.array(*[f"cut_{i}" for i in range(n_cuts)])).alias("_cut", "_rank"),
    )
    # The bucket each cut falls into, and its place among the rows of that bucket.
    before = F.col("_upto") - F.col("n")
    found = (
        per_bucket.join(cuts, label)
        .filter((before < F.col("_rank")) & (F.col("_rank") <= F.col("_upto")))
        .select(label, "_bucket", "_cut", (F.col("_rank") - before).alias("_place"))
    )
    found = small(found)
    place = F.row_number().over(Window.partitionBy(label, "_bucket").orderBy("_order", "_key"))
    edges = (
        rows.join(found.select(label, "_bucket"), [label, "_bucket"], "left_semi")
        .withColumn("_place", place)
        .join(found, [label, "_bucket", "_place"])
    )
    edge = F.struct("_order", "_key")
    limits = edges.groupBy(label).agg(
        *[F.max(F.when(F.col("_cut") == i, edge)).alias(f"_limit_{i}") for i in range(n_cuts)]
    )
    classes = per_bucket.select(label).distinct()
    limits = small(classes.join(limits, label, "left"))
    part = F.lit(n_cuts)
    for i in range(n_cuts):
        limit = F.col(f"_limit_{i}")
        inside = (F.col("_order") < limit["_order"]) | (
            (F.col("_order") == limit["_order"]) & (F.col(key) <= limit["_key"])
        )
        part = part - F.when(inside, 1).otherwise(0)
    return (
        df.withColumn("_order", order)
        .join(limits, label, "left")
        .withColumn("_part", part)
        .select(*whole.columns, "_part")
    )


def _bucket(order: Column, buckets: int) -> Column:
    """Which of ``buckets`` equal ranges of the 52-bit hash order a row falls into."""
    return F.floor(order / F.lit(2.0**52 / buckets)).cast("int")


def sample_n(
    df: DataFrame, key: str, n: int, seed: int = V.SEED, stream: str = "sample"
) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, for unique keys.

    The hash order is cut at the n-th row, as the splits do, whatever n is.
    """
    total = df.count()
    if total <= n:
        return df
    if n <= 0:
        return df.limit(0)
    shares = [Fraction(n, total), 1 - Fraction(n, total)]
    part = _with_part(df.withColumn("_all", F.lit(0)), key, "_all", shares, stream, seed, BUCKETS)
    return part.filter(F.col("_part") == 0).drop("_part", "_all")


def with_rank(
    df: DataFrame, groups: list[str], order: str, key: str, name: str, buckets: int = 1
) -> DataFrame:
    """Add each row's place (from 1) within its group by a hash order.

    A group is ranked piecewise: rows per bucket give the offset, so a group of any size is
    spread over ``buckets`` tasks.
    """
    keys = [*groups, "_bucket"]
    df = df.withColumn("_bucket", _bucket(F.col(order), buckets))
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*groups).orderBy("_bucket"))
    offsets = counts.select(*keys, (upto - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order, key))
    return (
        df.withColumn(name, place)
        .join(offsets, keys)
        .withColumn(name, F.col(name) + F.col("_before"))
        .drop("_bucket", "_before")
    )


def class_distribution(df: DataFrame, label: str = V.LABEL, split: str = "split") -> DataFrame:
    """Count and share of each class in the whole table (``raw``) and in every split."""
    counts = df.groupBy(split, label).agg(F.count("*").alias("n"))
    raw = counts.groupBy(label).agg(F.sum("n").alias("n")).select(F.lit("raw").alias(split), label, "n")
    both = raw.unionByName(counts)
    share = F.col("n") / F.sum("n").over(Window.partitionBy(split))
    return both.withColumn("share", share).orderBy(split, F.desc("share"), label)


def split_counts(df: DataFrame, split: str = "split", expected: tuple = ("train", "val", "eval")) -> DataFrame:
    """Rows per expected split; a missing split shows as zero."""
    counts = df.groupBy().agg(*[F.count(F.when(F.col(split) == s, 1)).alias(s) for s in expected])
    return counts.unpivot([], list(expected), split, "n")


def check_splits(df: DataFrame, split: str = "split") -> None:
    """Raise when one of train, val and eval holds no rows."""
    empty = [r[split] for r in split_counts(df, split).filter("n = 0").collect()]
    if empty:
        raise ValueError(f"no rows in split {', '.join(sorted(empty))}")
