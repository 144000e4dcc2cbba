"""Personal data: base patterns, and boosted candidates, with DataFrame functions only."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culprit.llm.quality import boost
from culprit.llm.spans import apart_from, covers, kept_as, span, with_matches, without_repeats, written_out

# A run of local-part characters that fails from its start fails from every later place, so
# matches begin at the start of a run or where the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

# High-recall generators; their proposals may overlap each other and the base spans.
GENERATORS = {
    "mail_like": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+",
    "number_like": r"\+?\(?[0-9][0-9\x20().-]{5,30}[0-9]",
}
CONTEXT = 24
CUES = r"(?i)\b(phone|tel|call|mobile|fax|card|visa|iban|account|ssn|passport|mail|contact|ip|host|address|born)\b"
TREES, DEPTH, RATE = 30, 3, 0.3
PRECISION = 0.9


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The checksum of a card number: every second digit from the right doubled."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, n - i, F.lit(1))) - 48
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def is_ip(found: Column) -> Column:
    return F.forall(F.split(found, r"\."), lambda part: part.cast("double") <= 255)


def is_card(found: Column) -> Column:
    return F.when(F.length(digits_of(found)).between(14, 19), luhn(digits_of(found)))


def is_phone(found: Column) -> Column:
    return F.length(digits_of(found)).between(10, 15)


def features(found: Column, before: Column, after: Column) -> dict[str, Column]:
    """Format and context of a proposal as small whole numbers with few values each."""
    count = lambda pattern, most: F.least(F.regexp_count(found, F.lit(pattern)), F.lit(most))
    return {
        "digits": count("[0-9]", 24),
        "groups": count("[0-9]+", 8),
        "longest": F.least(F.array_max(F.transform(F.split(found, "[^0-9]+"), F.length)), F.lit(20)),
        "dots": count(r"\.", 5),
        "dashes": count("-", 4),
        "blanks": count(r"\x20", 5),
        "plus": found.startswith("+").cast("int"),
        "bracket": found.contains("(").cast("int"),
        "at": found.contains("@").cast("int"),
        "letters": F.least(F.floor(F.regexp_count(found, F.lit("[A-Za-z]")) / 4), F.lit(6)).cast("int"),
        "cue": before.rlike(CUES).cast("int"),
        "letter_before": before.rlike("[A-Za-z]$").cast("int"),
        "letter_after": after.rlike("^[A-Za-z]").cast("int"),
        "line_start": before.rlike(r"(^|\n)[^\n\w]*$").cast("int"),
    }


def with_cell(generator: str):
    """A proposal as (start, end, cell): its features as one string name a cell of the model."""

    def write(m: Column) -> Column:
        cell = F.concat_ws(",", F.lit(generator), *features(m["found"], m["before"], m["after"]).values())
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), cell.alias("cell"))

    return write


def with_spans(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id``, the base spans by kind and the proposals of each generator."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    patterns = {**dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True)), **GENERATORS}
    for name, pattern in patterns.items():
        rows = with_matches(rows, "_text", pattern, f"_{name}", CONTEXT if name in GENERATORS else 0)
    keep = {"email": lambda m: F.lit(True), "ip": is_ip, "card": is_card, "phone": is_phone}
    rows = rows.withColumns({f"_{k}": kept_as(f"_{k}", k, i, keep[k]) for i, k in enumerate(KINDS)})
    rows = rows.withColumn("_base", F.concat(*[f"_{k}" for k in KINDS]))
    for name in GENERATORS:
        rows = rows.withColumn(f"_{name}", F.transform(f"_{name}", with_cell(name)))
    return rows.withColumn("_proposed", F.concat(*[f"_{name}" for name in GENERATORS])).drop("_text", *[f"_{n}" for n in GENERATORS])


def learn(spans: DataFrame, precision: float = PRECISION) -> list[str]:
    """The cells of feature values whose proposals are redacted.

    A proposal that covers a base span, which passed its checks, is a positive; the features
    do not contain those checks. Proposals of all documents are counted by cell, half (by
    hash of the id) to fit boosted trees and half to calibrate: per generator the lowest
    score from which the second half is right at the rate ``precision``. Features are small
    numbers, so the cells that reach the driver are bounded by their combinations.
    """
    def marks(p: Column) -> Column:
        held = F.lit(False)
        for kind in KINDS:
            held = held | ((F.size(f"_{kind}") > 0) & covers(p, F.col(f"_{kind}")))
        return F.struct(p["cell"].alias("cell"), held.cast("int").alias("y"))

    marked = F.transform("_proposed", marks)
    half = (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).alias("fit")
    rows = spans.select(half, F.explode_outer(marked).alias("p")).filter("p IS NOT NULL").groupBy("fit", "p.cell", "p.y").agg(F.count("*").alias("n"))
    counts = sorted(tuple(r) for r in rows.collect())
    chosen: list[str] = []
    for name in GENERATORS:
        mine = [r for r in counts if r[1].startswith(name + ",")]
        value = lambda cell: [float(v or 0) for v in cell.split(",")[1:]]
        fitted, checked = [r for r in mine if r[0]], [r for r in mine if not r[0]]
        if not fitted or not checked:
            continue
        x, y, n = (np.array([f(r) for r in fitted], float) for f in (lambda r: value(r[1]), lambda r: r[2], lambda r: r[3]))
        model = boost(x, y, TREES, DEPTH, rate=RATE, weight=n)
        score = model.score(np.array([value(r[1]) for r in checked]))
        y, n = np.array([r[2] for r in checked], float), np.array([r[3] for r in checked], float)
        limit = np.inf
        for level in np.unique(score):
            above = score >= level
            if (y * n)[above].sum() >= precision * n[above].sum():
                limit = level
                break
        cells = sorted({r[1] for r in mine})
        chosen += [c for c, s in zip(cells, model.score(np.array([value(c) for c in cells])), strict=True) if s >= limit]
    return chosen


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", precision: float = PRECISION) -> DataFrame:
    """``doc_id``, counts and digest of the base spans, and all spans, one row per row.

    Base kinds are ``email``, ``ip``, ``card`` and ``phone``. ``likely`` spans are proposals of
    the generators that the boosted trees score above their calibrated threshold and that
    overlap no base span. A null text is empty. Repeated rows give equal rows; a null id stays
    null; other columns are not read.
    """
    spans = with_spans(docs, key, text)
    chosen = learn(spans, precision)
    rows = spans.withColumn("_rest", apart_from("_proposed", [f"_{kind}" for kind in KINDS]))
    picked = F.filter("_rest", lambda p: p["cell"].isin(chosen)) if chosen else F.filter("_rest", lambda p: F.lit(False))
    rows = rows.withColumn("_more", without_repeats(F.transform(picked, lambda p: span(p["start"], p["end"], "likely", len(KINDS)))))
    return rows.select(
        "doc_id",
        *[F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(written_out(F.col("_base")), 256).alias("base_sha256"),
        written_out(F.concat("_base", "_more")).alias("spans"),
        F.size("_more").cast("long").alias("n_likely"),
    )
