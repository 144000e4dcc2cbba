import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from culprit.llm import packing
from culprit.llm.packing import Encoder, Piece, SumOfSquares

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER, ENCODER = Tokenizer.from_file(PATH), Encoder(PATH)


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def ids_of(text):
    return np.frombuffer(ENCODER.ids(text.encode()), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text(alphabet="aB's <|>endoftx 12.\t\né́  ẛ̣"))
def test_ids_by_parts_equal_those_of_the_whole_text(text):
    assert ids_of(text) == plain_ids(text)


@pytest.mark.parametrize("text", ["it's they'LL 're", "<|endoftext|> a<|startoftext|>b", "Å ́x", "ΣΑΣ İstanbul", "a1b22c", "'s's", "x" * 70_000 + "1" + "y" * 70_000])
def test_odd_texts(text):
    assert ids_of(text) == plain_ids(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aBsTmRevl'  \t\n!?.-09éÉßÿÀ÷×ñ") | st.text(alphabet="eE 1!'«é’\u0301\x00\x1c\u0085İſ"))
def test_plain_and_other_texts_equal_the_whole_way(text):
    assert ids_of(text) == plain_ids(text)


def test_plain_texts_take_no_detour_by_chunks():
    encoder, text = Encoder(PATH), "Élan vital, l'été 2024: it's PÈRE Ñandú!! Straße <b>"
    encoder.tokenizer = None
    assert np.frombuffer(encoder.ids(text.encode()), "<u4").tolist() == plain_ids(text)
    assert not encoder.chunks.newer
    assert {p.decode() for p in encoder.parts.newer} == set("élan vital , l ' été 2 0 4 : it 's père ñandú !! straße < b >".split())


def test_forgotten_parts_of_plain_texts_are_encoded_again(monkeypatch):
    monkeypatch.setattr(packing, "CACHED", 3)
    encoder = Encoder(PATH)
    for text in ["one two three four", "five six seven", "one six « eight nine", "two ten one"] * 3:
        assert np.frombuffer(encoder.ids(text.encode()), "<u4").tolist() == plain_ids(text)
        assert len(encoder.parts) <= 3 + 4 and len(encoder.parts.older) <= 3 + 4


def test_forgotten_parts_are_encoded_again(monkeypatch):
    monkeypatch.setattr(packing, "CACHED", 3)
    encoder = Encoder(PATH)
    for text in ["one two three four", "five six seven", "one six eight nine", "two ten one"] * 3:
        assert np.frombuffer(encoder.ids(text.encode()), "<u4").tolist() == plain_ids(text)
        assert len(encoder.chunks) <= 3 + 4


def plain_level(levels, size, window):
    """The level whose choice leaves the least sum of squares, the fullest of equals."""
    best = None
    for level in range(window - size + 1):
        if level and not levels[level]:
            continue
        after = dict(levels)
        after[level] = after.get(level, 0) - 1 if level else 0
        if level + size < window:
            after[level + size] = after.get(level + size, 0) + 1
        cost = sum(n * n for h, n in after.items() if 0 < h < window)
        if best is None or cost <= best[0]:
            best = (cost, level)
    return best[1]


def test_placement_is_the_least_sum_of_squares():
    window, draw = 32, random.Random(4)
    places, levels = SumOfSquares(window), defaultdict(int)
    for i in range(600):
        size = draw.choice([1, 3, 7, 8, 16, 17, 25, 31])
        level = plain_level(levels, size, window)
        done = places.place(Piece(i, 0, b"\0\0\0\0" * size, size))
        if level:
            levels[level] -= 1
        if level + size < window:
            levels[level + size] += 1
        assert bool(done) == (level + size == window)
        assert [int(n) for n in places.levels[1:window]] == [levels[h] for h in range(1, window)]
        assert all(len(places.open[h]) == levels[h] for h in range(1, window))


def check(docs, rows, window):
    """Every id in exactly one piece, sequences gapless, checksums right; the padded tokens."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for key, text in docs.items():
        ids, at = [*plain_ids(text), 2], 0
        for r in sorted(pieces.pop(key), key=lambda r: r["start"]):
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
    assert not pieces
    padded = 0
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= window
        padded += 0 if at & (at - 1) == 0 else window - at
    return padded


def test_every_id_is_packed_once(spark, prose):
    docs = {i: prose(n, i) for i, n in enumerate([0, 1, 5, 40, 300, 900, 5000, 17] * 6)} | {100: None, 101: "", 102: "word " * 20_000}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").selectExpr("*", "1 AS length", "2 AS sequence_id").repartition(3)
    rows = packing.pack(df, PATH, window=1024).collect()
    assert check(docs, rows, 1024) == 0


def test_repeated_and_null_keys(spark):
    rows = [(None, "a b"), (1, "same words"), (1, "same words"), (1, None)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    assert sum(r["length"] for r in got if r["doc_id"] is None) == 3
    assert sum(r["length"] for r in got if r["doc_id"] == 1) == 7
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)


def test_string_keys_and_empty_table(spark):
    got = packing.pack(spark.createDataFrame([("x", "some text")], "doc_id string, text string"), PATH)
    assert got.first()["doc_id"] == "x"
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    assert check({r["doc_id"]: r["text"] for r in docs.collect()}, rows, packing.WINDOW) == 0
