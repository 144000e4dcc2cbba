"""SimHash links against all pairs, and one document of each group."""

import random
import re

import numpy as np
import pytest
import xxhash

from culprit.llm import common, simhash

SCHEMA = "doc_id long, text string, fp string, row string, _id string"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def smallest_reachable(prints):
    """component of each distinct fingerprint by comparing all pairs."""
    values = sorted(set(prints))
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {v: root(v) for v in values}


def check(spark, rows, **more):
    prints = [plain(t) for _, t in rows]
    comp = smallest_reachable(prints)
    first = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            first[comp[p]] = min(i, first.get(comp[p], i))
    want = sorted([(i, f"{p:016x}", first.get(comp[p])) for (i, _), p in zip(rows, prints, strict=True)], key=str)
    docs = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA)
    got = simhash.near_duplicates(docs, **more).select("doc_id", "fingerprint", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == want
    return want


def edited(text, draw, n):
    words = text.split()
    for _ in range(n):
        words[draw.randrange(len(words))] = draw.choice(["one", "two", "three"])
    return " ".join(words)


@pytest.fixture
def rows(prose):
    draw = random.Random(1)
    out = []
    for g in range(40):
        base = prose(400, g)
        out += [(100 * g + k, edited(base, draw, k % 4)) for k in range(6)]
    out += [(9000 + i, prose(3 + i % 4, i)) for i in range(40)]
    return out


def test_links_of_copies(spark, rows):
    got = check(spark, rows)
    assert len({c for _, _, c in got}) < 200  # some copies link


def test_crowded_parts_are_cut(spark, rows):
    check(spark, rows, leaf_rows=2)


def test_odd_rows(spark):
    texts = [None, "", " \n\x0b", "One", "one two", "É x\x1cy z", "same text here now", "same text here now"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "same text here now"), (None, "lone one of a kind"), (6, "same text here now")]
    check(spark, [*rows, (99, "word " * 300_000)])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.one_per_group(empty).columns == empty.columns


def test_blocks_do_not_change_a_fingerprint(prose, monkeypatch):
    texts = [prose(n, n) for n in (1, 2, 3, 4, 50, 300)]
    whole = [simhash.fingerprint(t.encode()) for t in texts]
    monkeypatch.setattr(simhash, "word_blocks", lambda text, size: common.word_blocks(text, 13))
    assert [simhash.fingerprint(t.encode()) for t in texts] == whole == [plain(t) for t in texts]


def test_trie_pairs_with_either_half_in_the_lead():
    draw = np.random.default_rng(1)
    base = draw.integers(0, 2**63, 300, dtype=np.uint64)
    copies = [base]
    for _ in range(8):
        x = base.copy()
        for _ in range(draw.integers(0, 5)):
            x = x ^ (np.uint64(1) << draw.integers(0, 64, len(x)).astype(np.uint64))
        copies.append(x)
    values = np.unique(np.concatenate(copies))
    found = set()
    for key in (values, (values << np.uint64(32)) | (values >> np.uint64(32))):
        order = np.argsort(key)
        for i, j in simhash.trie_pairs(key[order], None, block=500):
            found |= {tuple(sorted(p)) for p in zip(order[i].tolist(), order[j].tolist(), strict=True)}
    near = np.triu(np.bitwise_count(values[:, None] ^ values[None]) <= 3, 1)
    assert found == set(zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True))


def test_one_document_of_each_group_stays(spark, rows, prose):
    rows = [*rows, (None, prose(400, 0)), (None, "null key alone"), (7000, "twin twin"), (7000, "twin twin"), (None, None), (8000, "")]
    docs = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA)
    comp = smallest_reachable([plain(t) for _, t in rows])
    want = {}
    for i, t in rows:
        c, order = comp[plain(t)], (i is None, i or 0, plain(t) ^ (1 << 63), t or "")
        want[c] = min(want.get(c, (order, i, t)), (order, i, t))
    got = simhash.one_per_group(docs)
    assert got.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted([(i, t) for _, i, t in want.values()], key=str)
    assert len(want) < len(rows) - 40


def test_budgets_beyond_the_halves_are_refused(spark):
    with pytest.raises(ValueError, match="at most 3"):
        simhash.one_per_group(spark.createDataFrame([], SCHEMA), budget=4)


def test_chains_of_components(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(5, 5)]
    got = dict(common.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1400)}
