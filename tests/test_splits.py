from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from culprit import fixed_values as V
from culprit.operators import splits
from culprit.functions.draws import shuffle_key

KEY = "incident_id"


def brute_force(rows, shares):
    """Parts by sorting each class whole; quotas by largest remainder."""
    classes = {}
    for key, label, order in rows:
        classes.setdefault(label, []).append((order, key))
    rest = {c: len(v) for c, v in classes.items()}
    part, start, left = {}, Counter(), sum(n for _, n in shares)
    for name, share in shares[:-1]:
        total = sum(rest.values())
        size = total * share // left
        left -= share
        exact = {c: divmod(n * size, total) for c, n in rest.items()}
        extra = size - sum(b for b, _ in exact.values())
        chosen = sorted(exact, key=lambda c: (-exact[c][1], c))[:extra]
        for c in rest:
            quota = exact[c][0] + (c in chosen)
            for _, key in sorted(classes[c])[start[c]: start[c] + quota]:
                part[key] = name
            start[c] += quota
            rest[c] -= quota
    for c, members in classes.items():
        for _, key in sorted(members)[start[c]:]:
            part[key] = shares[-1][0]
    return part


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_split_equals_sorting_every_class(incidents, buckets):
    got = {r[KEY]: r["split"] for r in splits.stratified_split(incidents, KEY, buckets=buckets).collect()}
    rows = incidents.select(KEY, V.LABEL, shuffle_key(KEY, "split", V.SEED)).collect()
    assert got == brute_force([tuple(r) for r in rows], [("train", 70), ("val", 15), ("eval", 15)])
    assert Counter(got.values()) == {"train": 2100, "val": 450, "eval": 450}


def test_one_hot_class(spark):
    df = spark.range(1000).select(F.col("id").alias(KEY), F.lit("all").alias(V.LABEL))
    counts = Counter(r["split"] for r in splits.stratified_split(df, KEY).collect())
    assert counts == {"train": 700, "val": 150, "eval": 150}


def test_equal_remainders_go_by_class_name(spark):
    df = spark.range(10).select(F.col("id").alias(KEY), F.when(F.col("id") < 5, "a").otherwise("b").alias(V.LABEL))
    rows = splits.stratified_holdout(df, KEY, test="0.5").groupBy(V.LABEL, "split").count().collect()
    counts = {(r[V.LABEL], r["split"]): r["count"] for r in rows}
    assert counts == {("a", "train"): 3, ("a", "test"): 2, ("b", "train"): 2, ("b", "test"): 3}


def test_folds_are_even_in_every_class(incidents):
    rows = splits.stratified_folds(incidents, KEY).groupBy(V.LABEL, "fold").count().collect()
    for label in V.ROOT_CAUSE_PRIOR:
        sizes = [r["count"] for r in rows if r[V.LABEL] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("train, val", [("0.9", "0.1"), (0, 0.1), (0.5, 0), ("1", "0.1"), (0.8, 0.3)])
def test_bad_shares(incidents, train, val):
    with pytest.raises(ValueError):
        splits.stratified_split(incidents, KEY, train=train, val=val)


def test_sample_is_exact_and_comes_first_in_the_hash_order(incidents):
    order = shuffle_key(KEY, "sample", 42)
    first = {r[KEY] for r in incidents.orderBy(order, KEY).limit(137).collect()}
    cut = {r[KEY] for r in splits.sample_n(incidents, KEY, 137).collect()}
    assert len(cut) == 137 and cut == first
    assert splits.sample_n(incidents, KEY, 10_000).count() == 3000
    assert splits.sample_n(incidents, KEY, 0).count() == 0


def test_quotas_of_large_tables_do_not_overflow(spark):
    counts = spark.createDataFrame([("a", 4_000_000_019), ("b", 6_000_000_000)], "label string, n long")
    shares = [Fraction(3_000_000_019, 10_000_000_019), 1 - Fraction(3_000_000_019, 10_000_000_019)]
    cuts = {r.label: r.cut_0 for r in splits.quotas(counts, "label", shares).collect()}
    assert sum(cuts.values()) == 3_000_000_019
    assert abs(cuts["a"] - 3_000_000_019 * 4_000_000_019 / 10_000_000_019) <= 1


def test_null_labels_are_split_like_any_class(spark):
    df = spark.range(1000).select(F.col("id").alias(KEY), F.when(F.col("id") % 10 > 0, F.lit("x")).alias("cause"))
    got = splits.stratified_split(df, KEY, "cause").groupBy("cause", "split").count().collect()
    assert {(r.cause, r.split): r["count"] for r in got if r.cause is None} == {(None, "train"): 70, (None, "val"): 15, (None, "eval"): 15}
    assert {(r.cause, r.split): r["count"] for r in got if r.cause} == {("x", "train"): 630, ("x", "val"): 135, ("x", "eval"): 135}


@pytest.mark.parametrize("buckets", [1, 16])
def test_rank_counts_from_one_in_every_group(spark, buckets):
    df = spark.range(500).select(
        F.col("id").alias(KEY), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("g"), shuffle_key("id", "r", 1).alias("o")
    )
    rows = splits.with_rank(df, ["g"], "o", KEY, "place", buckets).collect()
    for g in "xy":
        group = sorted((r["o"], r[KEY], r["place"]) for r in rows if r["g"] == g)
        assert [p for _, _, p in group] == list(range(1, len(group) + 1))


def test_distribution_and_missing_split(incidents):
    table = splits.stratified_split(incidents, KEY)
    rows = splits.class_distribution(table).collect()
    assert {r["split"] for r in rows} == {"raw", "train", "val", "eval"}
    for split in ("raw", "train", "val", "eval"):
        assert sum(r["share"] for r in rows if r["split"] == split) == pytest.approx(1)
    splits.check_splits(table)
    with pytest.raises(ValueError, match="eval"):
        splits.check_splits(table.filter("split <> 'eval'"))
