"""SimHash near-duplicates by a self-join of the binary trie of fingerprints."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from culprit.llm.common import components, kept_table, merge_labels, texts_of, word_blocks

SEED = 42
WORDS = 3
BUDGET = 3
LEAF_ROWS = 8192
FEWEST_BITS, MOST_BITS = 6, 18
BLOCK = 200_000


def bit_shares(text: bytes, words: int, seed: int) -> tuple[np.ndarray, int]:
    """How many shingles of a text have each of the 64 hash bits, and their number.

    Shingles are runs of ``words`` words with A-Z in lower case, repeats included; a text with
    fewer words is one shingle, one without words none. A text is read in blocks, so memory
    does not grow with its length.
    """
    ones, total, carry = np.zeros(64, np.int64), 0, []
    for block in word_blocks(text, 1 << 18):
        tokens = [*carry, *(w.lower() for w in block)]
        if len(tokens) >= words:
            hashes = _shingle_hashes(tokens, words, seed)
            ones += _bit_sums(hashes)
            total += len(hashes)
        carry = tokens[max(0, len(tokens) - words + 1) :]
    if not total and carry:
        total, ones = 1, _bit_sums(_shingle_hashes(carry, len(carry), seed))
    return ones, total


def _bit_sums(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """64-bit SimHash: a bit is 1 when more than half of the shingle hashes have it."""
    ones, total = bit_shares(text, words, seed)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def _shingle_hashes(tokens: list[bytes], words: int, seed: int) -> np.ndarray:
    """XXH64 of each run of ``words`` tokens joined by spaces."""
    joined = b" ".join(tokens)
    length = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(length + 1) - 1
    starts, stops = (ends - length)[: len(tokens) - words + 1].tolist(), ends[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], seed) for s, e in zip(starts, stops, strict=True)], dtype=np.uint64)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``doc_id``, ``body`` (a hash of the text, null for a null text) and ``fp`` of each document."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = texts_of(batch.column(2))
            texts = (data[s:e].tobytes() for s, e in zip(offsets[:-1], offsets[1:], strict=True))
            prints = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints)], ["doc_id", "body", "fp"])

    body = F.col(text).cast("string")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), body_hash(text).alias("body"), body.alias("text"))
    return rows.mapInArrow(add, "doc_id long, body long, fp long")


def body_hash(text: str) -> Column:
    return F.when(F.col(text).isNotNull(), F.xxhash64(F.col(text).cast("string")))


def trie_pairs(a: np.ndarray, b: np.ndarray | None, budget: int = BUDGET, block: int = BLOCK):
    """Yield index pairs of sorted keys within ``budget`` bits, half of them in the first half.

    Walks pairs of trie nodes from the highest bit
    down. A node is a range of the sorted array; going down splits both ranges by the next
    bit, crossing sides costs one bit, and a pair beyond the budget is dropped: half the
    budget in the first half of the bits, all of it after. Pairs of small nodes are compared
    by their remaining bits. ``b=None`` joins ``a`` with itself, each pair once. At most a few
    blocks of node pairs are held at a time, deepest first.
    """
    half = np.uint64(((1 << 32) - 1) << 32)
    own, b = b is None, a if b is None else b
    cut_a = [None] * 64
    cut_b = cut_a if own else [None] * 64

    def ones(array, cache, bit):
        if cache[bit] is None:
            set_bits = ((array >> np.uint64(63 - bit)) & np.uint64(1)).astype(np.int32)
            cache[bit] = np.concatenate([[0], np.cumsum(set_bits, dtype=np.int32)]).astype(np.int32)
        return cache[bit]

    stack = [(0, np.array([[0], [len(a)], [0], [len(b)], [0]], np.int32))]
    while stack:
        bit, nodes = stack.pop()
        size_a, size_b = nodes[1] - nodes[0], nodes[3] - nodes[2]
        twin = (nodes[0] == nodes[2]) if own else np.zeros(nodes.shape[1], bool)
        allowed = budget // 2 if bit <= 32 else budget
        alive = (size_a > 0) & (size_b > 0) & (nodes[4] <= allowed) & ~(twin & (size_a == 1))
        nodes, twin, size_a, size_b = nodes[:, alive], twin[alive], size_a[alive], size_b[alive]
        product = size_a.astype(np.int64) * size_b
        leaf = (product <= 16) if bit < 64 else np.ones(len(product), bool)
        for i, j in _all_pairs(nodes[:, leaf], block):
            if own:
                ordered = i < j
                i, j = i[ordered], j[ordered]
            apart = a[i] ^ b[j]
            near = (np.bitwise_count(apart) <= budget) & (np.bitwise_count(apart & half) <= budget // 2)
            if near.any():
                yield i[near], j[near]
        nodes, twin = nodes[:, ~leaf], twin[~leaf]
        if not nodes.shape[1]:
            continue
        sum_a, sum_b = ones(a, cut_a, bit), ones(b, cut_b, bit)
        mid_a = nodes[1] - (sum_a[nodes[1]] - sum_a[nodes[0]])
        mid_b = nodes[3] - (sum_b[nodes[3]] - sum_b[nodes[2]])
        low_a, high_a, low_b, high_b, spent = nodes
        children = np.concatenate(
            [
                np.stack([low_a, mid_a, low_b, mid_b, spent]),
                np.stack([mid_a, high_a, mid_b, high_b, spent]),
                np.stack([low_a, mid_a, mid_b, high_b, spent + 1]),
                np.stack([mid_a, high_a, low_b, mid_b, spent + 1])[:, ~twin],
            ],
            axis=1,
        )
        for at in range(0, children.shape[1], block):
            stack.append((bit + 1, children[:, at : at + block]))


def _all_pairs(nodes: np.ndarray, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs of each pair of ranges, in blocks of about ``block``."""
    size_b = (nodes[3] - nodes[2]).astype(np.int64)
    sizes = (nodes[1] - nodes[0]) * size_b
    ends = np.cumsum(sizes)
    for at in range(0, int(ends[-1]) if len(ends) else 0, block):
        pair = np.arange(at, min(at + block, int(ends[-1])))
        which = np.searchsorted(ends, pair, side="right")
        place = pair - (ends[which] - sizes[which])
        yield nodes[0][which] + place // size_b[which], nodes[2][which] + place % size_b[which]


def _join_parts(budget: int):
    """Links between two trie parts, as a star per group of linked nodes."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        key, node, side = rows["key"].to_numpy().view(np.uint64), rows["node"].to_numpy(), rows["side"].to_numpy()
        order = np.lexsort((key, side))
        key, node, side = key[order], node[order], side[order]
        label = np.arange(len(key))
        first = np.searchsorted(side, 1)
        own = first in (0, len(key))
        for i, j in trie_pairs(key, None, budget) if own else trie_pairs(key[:first], key[first:], budget):
            merge_labels(label, i, j if own else j + first)
        child = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"a": node[child], "b": node[label[child]]})

    return join


def links(prints: DataFrame, n: int, leaf_rows: int = LEAF_ROWS, budget: int = BUDGET) -> DataFrame:
    """Edges ``a``, ``b`` that connect the nodes of ``prints`` whose keys are within ``budget`` bits.

    ``prints`` has ``node`` and ``keys`` (signed longs, one per trie). Each trie is cut at a
    depth where parts hold about ``leaf_rows`` keys; a part meets the parts whose top bits
    differ in at most one. A part with many more is cut further by hash, and its pieces meet
    pairwise, so no task grows with a crowded part. The number of parts of a trie is at most 2
    to the ``MOST_BITS``, which bounds the broadcast of their sizes.
    """
    depth = min(MOST_BITS, max(FEWEST_BITS, math.ceil(math.log2(max(1, n) / leaf_rows))))
    rows = prints.select("node", F.posexplode("keys").alias("trie", "key"))
    rows = rows.withColumn("own", F.shiftrightunsigned("key", 64 - depth).cast("int"))
    sizes = rows.groupBy("trie", "own").agg(F.ceil(F.count("*") / (4 * leaf_rows)).cast("int").alias("pieces"))
    sizes = kept_table(sizes, "trie-parts")
    rows = rows.join(F.broadcast(sizes), ["trie", "own"])
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int")).drop("pieces")
    flips = F.explode(F.array(F.lit(0), *[F.lit(1 << i) for i in range(depth)]))
    rows = rows.withColumn("flip", flips).withColumn("other", F.col("own").bitwiseXOR(F.col("flip")))
    rows = rows.join(F.broadcast(sizes.withColumnRenamed("own", "other")), ["trie", "other"])
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    mine = F.col("own").cast("long") * (1 << 32) + F.col("piece")
    theirs = F.col("other").cast("long") * (1 << 32) + F.col("with")
    ends = [F.least(mine, theirs).alias("u"), F.greatest(mine, theirs).alias("v")]
    rows = rows.select("trie", *ends, (mine > theirs).cast("int").alias("side"), "key", "node")
    return rows.groupBy("trie", "u", "v").applyInPandas(_join_parts(budget), "a long, b long")


def rotated(fp: str) -> Column:
    """Both halves of a 64-bit key in the lead: of three differing bits one half has at most one."""
    other = F.shiftleft(fp, 32).bitwiseOR(F.shiftrightunsigned(fp, 32))
    return F.array(F.col(fp), other)


def grouped(prints: DataFrame, leaf_rows: int = LEAF_ROWS, budget: int = BUDGET) -> DataFrame:
    """``fp``, its smallest ``first`` id, and ``comp``: a number shared by linked fingerprints."""
    if not 0 <= budget <= BUDGET:
        raise ValueError(f"halves of a fingerprint find links of at most {BUDGET} bits, not {budget}")
    distinct = kept_table(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    found = links(distinct.select(F.col("fp").alias("node"), rotated("fp").alias("keys")), distinct.count(), leaf_rows, budget)
    linked = components(found).withColumnRenamed("node", "_node")
    groups = distinct.join(linked, distinct["fp"] == linked["_node"], "left")
    return groups.select("fp", "first", F.coalesce("comp", "fp").alias("comp"))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", leaf_rows: int = LEAF_ROWS, words: int = WORDS, budget: int = BUDGET
) -> DataFrame:
    """``doc_id``, ``fp``, ``fingerprint`` and ``component_id`` of every document.

    Fingerprints of shingles of ``words`` words link at ``budget`` (at most three) or fewer
    differing bits; ``component_id`` is the smallest ``doc_id`` reachable. Equal fingerprints
    are joined once, however many documents share them. A null or empty text has fingerprint
    zero and is linked like any other. Rows that repeat a ``doc_id`` each give a row. A null
    ``doc_id`` takes part but names no component: where no other id is reachable
    ``component_id`` is null. Ids are whole numbers. Other columns are not read.
    """
    prints = kept_table(fingerprints(docs, key, text, words), "fingerprints")
    groups = grouped(prints, leaf_rows, budget)
    first = groups.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = kept_table(groups.join(first, "comp").select("fp", "component_id"), "fingerprint-components")
    out = prints.join(named, "fp")
    return out.select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """The documents without near copies: one row of each group of ``near_duplicates`` stays.

    It keeps the row with the smallest id, a null id coming last; then the smallest
    fingerprint, then the smallest row in the order of its columns. Texts are hashed once:
    rows are found again by their id and the hash of their text.
    """
    prints = kept_table(fingerprints(docs, key, text, words), "fingerprints")
    groups = grouped(prints, budget=budget)
    order = F.struct(F.col("first").isNull().alias("none"), "first", "fp")
    winners = groups.groupBy("comp").agg(F.min(order).alias("w")).select(F.col("w.fp").alias("fp"), F.col("w.first").alias("first"))
    winners = prints.join(winners, "fp").filter(F.col("doc_id").eqNullSafe(F.col("first")))
    winners = kept_table(winners.select("fp", F.col("doc_id").alias("id"), "body").distinct(), "winners")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).cast("long").alias("_id"), body_hash(text).alias("_body"))
    same = F.col("_id").eqNullSafe(F.col("id")) & F.col("_body").eqNullSafe(F.col("body"))
    kept = rows.join(winners.hint("merge"), same)
    return kept.groupBy("fp").agg(F.min("row").alias("row")).select("row.*")
