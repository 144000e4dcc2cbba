"""The byte network: held-out accuracy, its gradients, whole texts, odd rows."""

import zlib

import numpy as np

from culprit.llm import language_id

SCHEMA = "doc_id long, text string, lang string, source string, score string"


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = dict(docs.select("doc_id", "lang").collect())
    got = language_id.identify(docs).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.93
    assert all(0 <= r.score <= 1 for r in got)


def test_gradients_equal_differences():
    draw = np.random.default_rng(2)
    codes = draw.integers(0, 256, (7, 3)).astype(np.int16)
    codes[5:, 1] = 256
    target = np.array([0, 1, 1])
    wide = lambda *shape: draw.standard_normal(shape) * 0.4
    net = language_id.Network(wide(2, 6, 257), wide(2, 6, 2), wide(2, 4), wide(2), ["a", "b"])

    def loss():
        ahead, _ = language_id._steps(net, 0, codes, False)
        back, _ = language_id._steps(net, 1, codes, False)
        p = [language_id._scores(net, ahead[t], back[t])[target, np.arange(3)] for t in range(len(codes))]
        valid = codes < 256
        return -(np.log(np.array(p)) * valid).sum() / valid.sum()

    slopes = language_id._gradients(net, codes, target)
    for weights, slope in zip((net.table, net.cross, net.out, net.bias), slopes, strict=True):
        for at in draw.integers(0, weights.size, 40):
            if weights is net.table:
                at = np.ravel_multi_index((at % 2, at % 6, int(codes[at % 5, 0])), weights.shape)
            flat = weights.reshape(-1)
            kept, step = flat[at], 1e-4
            flat[at] = kept + step
            high = loss()
            flat[at] = kept - step
            low = loss()
            flat[at] = kept
            assert abs((high - low) / (2 * step) - slope.reshape(-1)[at]) < 2e-4


def test_windows_cover_every_byte_once(monkeypatch):
    monkeypatch.setattr(language_id, "LANES", 3)
    texts = [b"", b"a", b"abcdefgh", b"", bytes(range(97, 117)), b""]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    seen = [b"" for _ in texts]
    for doc, codes in language_id.windows(data, offsets, 4):
        for lane, d in enumerate(doc):
            seen[d] += bytes(c for c in codes[:, lane].tolist() if c < 256)
    assert seen == texts


def test_odd_rows(spark, prose):
    rows = [(i, prose(40, i), "en") for i in range(60)] + [(100 + i, "äöü ßich ßü " + " ".join(w[::-1] + "ß" for w in prose(40, i).split()), "de") for i in range(60)]
    rows += [(300, None, "en"), (301, "", "de"), (302, "123 -- 4", "de"), (303, prose(60_000, 5), None), (None, prose(9, 1), "en"), (304, prose(9, 1), "en"), (304, prose(9, 1), "en")]
    docs = spark.createDataFrame([(*r, "s", "x") for r in rows], SCHEMA)
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert {by[i].lang_pred for i in (300, 301, 302)} == {"und"}
    assert by[303].lang_pred == "en"
    assert by[None].held_out is False
    assert np.mean([by[r[0]].lang_pred == r[2] for r in rows[:120]]) > 0.95


def test_nothing_to_learn_from_or_to_label(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert language_id.identify(empty).collect() == []
    one = spark.createDataFrame([(1, "some text", None, "s", "x")], SCHEMA)
    assert [(r.lang_pred, r.score) for r in language_id.identify(one).collect()] == [("und", 0.0)]
