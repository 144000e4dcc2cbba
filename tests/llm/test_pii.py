"""Personal data against Python's own expressions, and near misses found by the candidates."""

import hashlib
import random
import re

from culprit.llm import pii

SCHEMA = "doc_id long, text string, spans string"


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


def written(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


TEXTS = [
    None,
    "",
    "é😀 a.b+c@d-e.f.g, x@y @z.com a@b.c_d@e.f a@b.c.d@e.f ..@a.b",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8.9 000255.1.1.1 1234567890123.1.1.1 1.2.3",
    "4111 1111 1111 1111 4111111111111112 4111-1111-1111-1111 12 41111 1111  1111 5500005555555559 6011000990139424x",
    "+1 (383) 555-6083 +44 20 7946 0958. +123 +1-2-3-4-5-6-7-8-9-0 +1234567890123456 ++49 (0)30.123456",
    "a" * 20_000 + " " + "1" * 20_000 + " " + "a." * 20_000 + "@x " + "x@" + "y." * 20_000 + "z +" + "1 " * 9_000,
]


def test_base_spans(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "x"), (None, TEXTS[2], None)]
    got = pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = base_spans(TEXTS[2 if r.doc_id is None else r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(written(want).encode()).hexdigest(), r.doc_id
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[1] == k for s in want) for k in range(4))
        assert set(written(want).split(",")) <= set(r.spans.split(","))


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    for r in pii.find_personal_data(docs).collect():
        assert r.base_sha256 == hashlib.sha256(written(base_spans(texts[r.doc_id])).encode()).hexdigest()


def test_near_misses_are_added_and_years_are_not(spark, prose):
    draw = random.Random(4)

    def card():
        while True:
            digits = "4" + "".join(draw.choice("0123456789") for _ in range(15))
            if luhn(digits):
                return digits

    rows, missed = [], {}
    for i in range(400):
        number = card()
        text = prose(12, i)
        if i % 20 == 0:
            number = number[:-1] + str((int(number[-1]) + 1) % 10)
            missed[i] = f"likely:{len(text) + 1}:{len(text) + 17}"
        rows.append((i, f"{text} {number} {prose(5, i)} 1999 2001 {prose(3, -i)} 12 34 56", None))
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i].spans == span for i, span in missed.items())
    assert sum(r.n_likely for r in got.values()) == len(missed)


def test_empty_table(spark):
    empty = pii.find_personal_data(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    assert empty.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_likely"]


def test_a_text_with_very_many_matches(spark):
    text = " ".join(f"a{i}@b{i}.com" for i in range(20_000))
    row = pii.find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_email == 20_000 and row.spans.startswith("email:0:9,email:10:19,")
