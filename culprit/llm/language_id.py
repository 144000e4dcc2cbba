"""Language ID by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from culprit.llm.common import crc_part, first_by_hash, texts_of

UNITS = 8
WINDOW = 128
TRAIN_ROWS = 6_000
STEPS = 300
BATCH = 128
RATE = 0.015
LANES = 4096
UNDECIDED = "und"


@dataclass
class Network:
    """Weights of both directions, bytes -> gates -> languages, and the language names.

    One step, with x the row of the byte table and s(v) = clip(v / 4 + 1/2, 0, 1),
    g(v) = v / (1 + |v|):  z = s(x_z + U_z h), r = s(x_r + U_r h), c = g(x_c + r * U_c h),
    h' = h + z * (c - h).
    """

    table: np.ndarray  # (2, 3 units, 257): byte weights with biases; column 256 is padding
    cross: np.ndarray  # (2, 3 units, units)
    out: np.ndarray  # (languages, 2 units)
    bias: np.ndarray  # (languages,)
    names: list[str]


def _steps(net: Network, way: int, codes: np.ndarray, keep: bool):
    """States of one direction over ``codes`` (time, lanes); ``keep`` adds what training needs."""
    units = net.cross.shape[2]
    h = np.zeros((units, codes.shape[1]), np.float32)
    states, kept = [], []
    weights, cross = net.table[way], net.cross[way]
    order = range(len(codes)) if way == 0 else range(len(codes) - 1, -1, -1)
    for t in order:
        x = weights[:, codes[t]]
        u = cross @ h
        gates = x[: 2 * units] + u[: 2 * units]
        gates *= 0.25
        gates += 0.5
        open_gates = np.clip(gates, 0.0, 1.0)
        z, r = open_gates[:units], open_gates[units:]
        v = x[2 * units :] + r * u[2 * units :]
        c = v / (1.0 + np.abs(v))
        if keep:
            kept.append((t, h, u[2 * units :], gates, z, r, v, c))
        h = h + z * (c - h)
        states.append(h)
    if way:
        states.reverse()
    return states, kept


def _scores(net: Network, ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Language probabilities (languages, lanes) of one position."""
    units = ahead.shape[0]
    logits = net.out[:, :units] @ ahead + net.out[:, units:] @ back + net.bias[:, None]
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def windows(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of up to ``LANES`` windows covering all bytes: document numbers and codes (time, lanes).

    A text is cut every ``window`` bytes; the last window is filled up with code 256.
    """
    length = np.diff(offsets)
    count = -(-length // window)
    ends = np.cumsum(count)
    for at in range(0, int(ends[-1]) if len(ends) else 0, LANES):
        lane = np.arange(at, min(at + LANES, int(ends[-1])))
        doc = np.searchsorted(ends, lane, side="right")
        start = offsets[doc] + (lane - (ends[doc] - count[doc])) * window
        place = start[None, :] + np.arange(window)[:, None]
        inside = place < offsets[doc + 1][None, :]
        codes = np.where(inside, data[np.minimum(place, len(data) - 1)].astype(np.int16), np.int16(256))
        yield doc, codes


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean probability of each language over all bytes of each text: (texts, languages)."""
    total = np.zeros((len(offsets) - 1, len(net.names)))
    for doc, codes in windows(data, offsets):
        ahead, _ = _steps(net, 0, codes, False)
        back, _ = _steps(net, 1, codes, False)
        sums = np.zeros((len(net.names), codes.shape[1]), np.float32)
        for t in range(len(codes)):
            sums += _scores(net, ahead[t], back[t]) * (codes[t] < 256)
        np.add.at(total, doc, sums.T.astype(np.float64))
    size = total.sum(axis=1, keepdims=True)
    return np.divide(total, size, out=np.full_like(total, 1.0 / max(1, len(net.names))), where=size > 0)


def train(
    codes: np.ndarray, target: np.ndarray, names: list[str], units: int = UNITS, steps: int = STEPS, rate: float = RATE, seed: int = 3
) -> Network:
    """Fit by backpropagation through time with Adam; the loss is cross-entropy at every byte.

    ``steps`` batches are drawn, going through all windows in turn.

    ``codes`` is (windows, time) with 256 past the end, ``target`` the language number of each.
    """
    draw = np.random.default_rng(seed)
    normal = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
    net = Network(
        normal(2, 3 * units, 257, scale=0.3), normal(2, 3 * units, units, scale=0.3),
        normal(len(names), 2 * units, scale=0.3), np.zeros(len(names), np.float32), names,
    )
    weights = [net.table, net.cross, net.out, net.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    mixed = np.zeros(0, np.int64)
    for step in range(1, steps + 1 if len(codes) else 1):
        while len(mixed) < BATCH:
            mixed = np.concatenate([mixed, draw.permutation(len(codes))])
        rows, mixed = mixed[:BATCH], mixed[BATCH:]
        slopes = _gradients(net, codes[rows].T, target[rows])
        speed = rate * (1 - 0.9 * step / steps)
        for w, m, v, g in zip(weights, first, second, slopes, strict=True):
            g = np.clip(g, -1.0, 1.0)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= speed * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


def _gradients(net: Network, codes: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    units, lanes = net.cross.shape[2], codes.shape[1]
    ahead, kept_ahead = _steps(net, 0, codes, True)
    back, kept_back = _steps(net, 1, codes, True)
    valid = codes < 256
    weight = 1.0 / max(1, valid.sum())
    d_table, d_cross = np.zeros_like(net.table), np.zeros_like(net.cross)
    d_out, d_bias = np.zeros_like(net.out), np.zeros_like(net.bias)
    pull = [[None] * len(codes), [None] * len(codes)]
    for t in range(len(codes)):
        d = _scores(net, ahead[t], back[t])
        d[target, np.arange(lanes)] -= 1.0
        d *= valid[t] * weight
        d_out[:, :units] += d @ ahead[t].T
        d_out[:, units:] += d @ back[t].T
        d_bias += d.sum(axis=1)
        pull[0][t], pull[1][t] = net.out[:, :units].T @ d, net.out[:, units:].T @ d
    for way, kept in ((0, kept_ahead), (1, kept_back)):
        cross, dh = net.cross[way], np.zeros((units, lanes), np.float32)
        for t, h, u, gates, z, r, v, c in reversed(kept):
            dh = dh + pull[way][t]
            dz, dc = dh * (c - h), dh * z
            dv = dc / np.square(1.0 + np.abs(v))
            du = dv * r
            dg = np.concatenate([dz, dv * u]) * 0.25 * ((gates > 0) & (gates < 1))
            through = np.concatenate([dg, du])
            d_cross[way] += through @ h.T
            np.add.at(d_table[way].T, codes[t], np.concatenate([dg, dv]).T)
            dh = dh * (1 - z) + cross.T @ through
    return [d_table, d_cross, d_out, d_bias]


def sample(docs: DataFrame, key: str, text: str, lang: str, rows: int, window: int) -> DataFrame:
    """``lang`` and a window of bytes of the ``rows`` documents that come first by a hash.

    The window starts at a place chosen by hash anywhere in the text.
    """
    able = docs.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    room = F.greatest(F.lit(1), F.length(text) - window + 1).cast("long")
    start = F.pmod(F.xxhash64(F.col(text), F.lit(1)), room).cast("int") + 1
    piece = F.substring(F.encode(F.substr(F.col(text), start, F.lit(window)), "UTF-8"), 1, window)
    picked = able.select(F.col(lang).cast("string").alias("lang"), piece.alias("piece"), F.xxhash64(F.col(key), F.col(text)).alias("_h"))
    return first_by_hash(picked, "_h", rows).orderBy("_h", "lang", "piece").limit(rows)


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> Network:
    """Train on windows of at most ``rows`` documents that have a language and a letter."""
    picked = sample(labelled, key, text, lang, rows, WINDOW).select("lang", "piece").collect()
    names = sorted({r["lang"] for r in picked})
    codes = np.full((len(picked), WINDOW), 256, np.int16)
    for i, r in enumerate(picked):
        codes[i, : len(r["piece"])] = np.frombuffer(bytes(r["piece"]), np.uint8)
    target = np.array([names.index(r["lang"]) for r in picked], np.int64)
    return train(codes, target, names)


def predict(docs: DataFrame, net: Network, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """All columns (or ``keep``), ``lang_pred`` and ``score``, the pooled probability of that language.

    Every byte of a text is labelled, in windows whose states start at zero; probabilities
    are averaged over all of them. A null text, or one without a letter, is ``und`` with
    score 0; so is everything when no language was learned. Added columns replace others of
    that name. Rows are independent, so repeated rows get equal results.
    """
    keep = [c for c in keep or docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(net)
    fields = [T.StructField("row", docs.select(*keep).schema), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            offsets, data = texts_of(batch.column(1))
            able = (np.diff(offsets) > 0) & bool(model.names)
            share = pooled(model, data, offsets) if model.names else np.zeros((len(able), 1))
            best = share.argmax(axis=1)
            names = [model.names[b] if ok else UNDECIDED for b, ok in zip(best, able, strict=True)]
            score = np.where(able, np.clip(share[np.arange(len(best)), best], 0.0, 1.0), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score)], [f.name for f in fields])

    # A text without a letter is sent as an empty one.
    body = F.col(text).cast("string")
    rows = docs.select(F.struct(*keep).alias("row"), F.when(body.rlike(r"\p{L}"), body).otherwise(""))
    return rows.mapInArrow(label, T.StructType(fields)).select("row.*", "lang_pred", "score")


def held_out(key: str = "doc_id", parts: int = 5) -> Column:
    return F.coalesce(crc_part(key, parts) == 0, F.lit(False))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every document.

    The network learns from rows outside the held-out fifth; a row with a null id is in
    neither. Only the text is an input of a prediction.
    """
    net = fit(docs.filter(crc_part(key, 5) != 0).select(key, text, lang), key, text, lang)
    rows = docs.select(F.col(key).alias("doc_id"), held_out(key).alias("held_out"), F.col(text).alias("_body"))
    return predict(rows, net, "_body", keep=["doc_id", "held_out"])
