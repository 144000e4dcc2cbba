"""The mixture's pieces against its shares, its targets against simple resharing, odd rows."""

import random
from collections import Counter, defaultdict

import pytest

from culprit.llm import mixture

SCHEMA = "doc_id long, text string, source string, size string, _at string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)


def reshared(sizes):
    """Targets by resharing the excess until none is above."""
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    open_, left, target = set(names), float(sum(sizes.values())), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 3.0 * sizes[s] for s in full}
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


@pytest.fixture
def rows(prose):
    draw = random.Random(1)
    sources = ["hot"] * 8 + ["a", "b", "c", None, "é"]
    return [(i, prose(draw.randint(1, 300), i), draw.choice(sources)) for i in range(600)] + [(900, "few words", "tiny"), (901, None, "hot"), (902, " ", "none at all")]


def test_targets_and_shares(spark, rows):
    pieces, shares = mixture.mix(frame(spark, rows))
    shares = shares.collect()
    assert len(shares) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in shares:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = reshared(sizes)
    block = max(1, sum(sizes.values()) // 65_536)
    for r in shares:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-12)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 30 * block, s
    got, slots = defaultdict(int), Counter()
    for p in pieces.collect():
        assert 0 <= p.from_word < p.to_word
        got[p.doc_id] += p.to_word - p.from_word
        slots[p.slot] += p.to_word - p.from_word
    assert got == {r.doc_id: r.taken for r in shares if r.taken}
    assert max(slots.values()) <= block


def test_reruns_agree_whatever_the_partitions(spark, rows):
    once = sorted(mixture.mix(frame(spark, rows).repartition(7))[1].collect(), key=str)
    assert once == sorted(mixture.mix(frame(spark, rows[::-1]).repartition(3))[1].collect(), key=str)


def test_small_blocks_spread_a_source_over_the_schedule(spark, rows):
    pieces, _ = mixture.mix(frame(spark, rows))
    slots = {p.slot for p in pieces.filter("source = 'hot'").collect()}
    n = max(slots) + 1
    tenths = Counter(s * 10 // n for s in slots)
    assert max(tenths.values()) - min(tenths.values()) <= 30 + 0.1 * max(tenths.values())


def test_odd_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, "a b c", "x"), (None, None, None), (2, "", None), (3, "word " * 200_000, "y")]
    shares = mixture.mix(frame(spark, rows))[1].collect()
    assert sorted((r.size, r.source_size) for r in shares) == [(0, 0), (0, 0), (2, 7), (2, 7), (3, 7), (200_000, 200_000)]
    assert all(r.taken <= 3 * r.size for r in shares)


@pytest.mark.parametrize("rows", [[], [(1, None, "x"), (2, " ", None)]])
def test_nothing_to_mix(spark, rows):
    pieces, shares = mixture.mix(frame(spark, rows))
    assert pieces.count() == 0
    assert [(r.size, r.target, r.taken) for r in shares.collect()] == [(0, 0.0, 0)] * len(rows)
