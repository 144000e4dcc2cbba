"""Planted benchmark questions, verbatim and with other numbers, names and units."""

import pytest

from culprit.llm import decontaminate

SCHEMA = "doc_id long, text string, item_id string, _id string, row string"
QUESTIONS = [
    (1, "A train leaves the station at 9 and travels 120 km in 3 hours while Maria walks 120 m to work; how fast does the train travel?"),
    (2, "Peter has 12 apples and gives 5 apples to Anna, then Anna returns 2 apples to Peter because the basket was full already."),
    (3, "what is the capital city of that country"),
    (4, "too short"),
    (5, None),
    (6, "1 2 3 4 5 6 7 8 9 10 11 12"),
]


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(*q, "e") for q in QUESTIONS], "item_id long, text string, doc_id string")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "i", "u", "r") for r in rows], SCHEMA)


def found(spark, rows, benchmark, **more):
    return {(r._id, r.item_id): r.changed for r in decontaminate.matches(frame(spark, rows), benchmark, **more).collect()}


def rows_of(prose):
    first, second = QUESTIONS[0][1], QUESTIONS[1][1]
    other = first.replace("120", "450").replace(" 9 ", " 11 ").replace(" 3 ", " seven ").replace("km", "miles").replace("Maria", "Olga")
    mixed_up = first.replace("travels 120", "travels 450")  # one value, two values
    return [
        (1, f"{prose(20, 1)} {first} {prose(30, 2)}"),
        (2, prose(2000, 3) + "\n" + second.replace(" ", "  ") + "\n" + prose(10, 4)),
        (3, f"{prose(5, 5)} {other} {prose(5, 6)}"),
        (4, f"{prose(5, 5)} {mixed_up} {prose(5, 6)}"),
        (5, prose(500, 7)),
        (6, QUESTIONS[2][1].upper()),
        (7, None),
        (8, ""),
        (9, "21 22 23 24 25 26 27 28 29 30 31 32 33"),
        (10, " ".join(first.split()[:9])),
        (None, second),
        (11, prose(30_000, 8) + " " + first + " " + prose(30_000, 9)),
        (12, f"{first} {second}"),
        (12, f"{first} {second}"),
    ]


def test_planted_questions(spark, prose, benchmark):
    got = found(spark, rows_of(prose), benchmark)
    assert set(got) == {(1, 1), (2, 2), (3, 1), (6, 3), (None, 2), (11, 1), (12, 1), (12, 2)}
    assert got[3, 1] == 5
    assert {v for k, v in got.items() if k != (3, 1)} == {0}


def test_large_benchmarks_are_matched_in_parts(spark, prose, benchmark):
    assert set(found(spark, rows_of(prose), benchmark, most=100)) >= {(1, 1), (2, 2), (6, 3), (11, 1), (12, 1), (12, 2)}


def test_removal_keeps_the_rest_whole(spark, prose, benchmark):
    docs = frame(spark, rows_of(prose))
    left = decontaminate.remove_contaminated(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted(left.select("doc_id", "text").collect()) == sorted(r for r in docs.select("doc_id", "text").collect() if r.doc_id in (4, 5, 7, 8, 9, 10))


def test_given_table(spark):
    folder = "/root/testdata/sf0.01"
    docs, benchmark = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = [(r.doc_id, f" {' '.join(r.text.split())} ") for r in docs.select("doc_id", "text").collect()]
    items = [(r.item_id, f" {' '.join(r.text.split())} ") for r in benchmark.collect()]
    exact = {(i, j) for i, t in texts for j, q in items if q in t}
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert exact <= got
    assert len(got) <= 1.3 * len(exact) + 2


def test_empty_tables(spark, prose, benchmark):
    assert decontaminate.contaminated(frame(spark, []), benchmark).count() == 0
    assert decontaminate.contaminated(frame(spark, rows_of(prose)), benchmark.filter("false")).count() == 0


def test_edited_questions_and_other_case(spark, prose, benchmark):
    first, second = QUESTIONS[0][1], QUESTIONS[1][1]
    words = second.split()
    rows = [
        (20, " ".join([*words[:10], "really", *words[10:]])),
        (21, " ".join(words[:11] + words[12:])),
        (22, " ".join([*words[:7], "of", "the", *words[7:]])),
        (23, second.upper()),
        (24, second.lower()),
        (25, second.replace("Anna", "Mary Ann").replace("12", "twenty five")),
        (26, f"Question Five {second}"),
        (27, " ".join([prose(3, 1), *first.split()[:12], "slowly", *first.split()[12:], prose(3, 2)])),
        (28, " ".join(words[:9] + [prose(20, 3)])),
        (29, second.replace("Peter", "Olga").replace("Anna", "Olga")),
        (30, prose(3, 4) + " 7 8 9" * 100_000 + " " + second),
    ]
    got = found(spark, rows, benchmark)
    assert set(got) == {(i, 2) for i in (20, 21, 22, 23, 24, 25, 26, 29, 30)} | {(27, 1)}
    assert {i: c for (i, _), c in got.items() if c} == {25: 2, 29: 2}


def test_edits_of_the_given_benchmark(spark):
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    rows = []
    for r in benchmark.collect():
        words = r.text.split()
        half = len(words) // 2
        edits = [[*words[:half], "xyzzy", *words[half:]], words[:half] + words[half + 1 :], r.text.upper().split(), r.text.lower().split()]
        rows += [(10 * r.item_id + n, " ".join(e)) for n, e in enumerate(edits)]
    got = found(spark, rows, benchmark)
    missed = [i for i, _ in rows if (i, i // 10) not in got]
    assert len([i for i in missed if i % 10 > 1]) == 0
    assert len(missed) <= 0.05 * len(rows)


def plain_form(canon, token):
    """The form of a token, asked in the order numbers, units, names, other words."""
    bare = token.strip(decontaminate.EDGES)
    low = bare.decode().casefold().encode()
    if low.decode() in decontaminate.NUMBERS or decontaminate.DIGITS.match(low):
        return b"<number>"
    if low.decode() in decontaminate.UNITS:
        return b"<unit>"
    word = bare.decode()
    if low in canon.names or (low not in canon.known and len(word) > 1 and word[0].isupper()):
        return b"<name>"
    return low


def test_numbers_of_tokens_follow_their_forms():
    texts = [t for _, t in QUESTIONS if t] + ["Second Ten 3rd MB élan Élise i, straße ... 5% Σας"]
    canon = decontaminate.Canon(*decontaminate.known_words(texts))
    forms = sorted({canon(w) for t in texts for w in t.encode().split()})
    vocabulary = {form: i + 1 for i, form in enumerate(forms)}
    numbered = decontaminate.Numbered(canon, vocabulary)
    odd = "ÉLAN élise, STRASSE Straße. I Ω Ωmega 𝐀 𝐀b X Xy xY é É Éa «Anna» (Anna) $5, +7) -3% 12:30 1a4 :a @b 9: TEN! km/h. <number> '' ΣΑΣ ſecond".split()
    for token in [w.encode() for w in odd + " ".join(texts).split() + " ".join(texts).upper().split()]:
        form = plain_form(canon, token)
        number = vocabulary.get(form, 0)
        closed = token[-1:] in decontaminate.CLOSING
        assert canon(token) == form
        assert numbered[token] == (-2 * number - closed if number and form in decontaminate.PLACEHOLDERS.values() else number), token


def test_a_text_of_one_block_is_cut_into_runs_once(monkeypatch):
    import types

    import numpy as np
    import pyarrow as pa

    scan, calls, cut = [], [], decontaminate.runs_of
    context = types.SimpleNamespace(broadcast=lambda value: types.SimpleNamespace(value=value))
    docs = types.SimpleNamespace(sparkSession=types.SimpleNamespace(sparkContext=context), mapInArrow=lambda f, _: scan.append(f))
    item = "one train leaves the station and travels along this river until it stops"
    canon = decontaminate.Canon(*decontaminate.known_words([item]))
    vocabulary = {form: i + 1 for i, form in enumerate(sorted({canon(w) for w in item.encode().split()}))}
    monkeypatch.setattr(decontaminate, "runs_of", lambda numbers: calls.append(1) or cut(numbers))
    decontaminate.document_windows(docs, canon, vocabulary, np.full(decontaminate.FILTER_BITS // 8, 255, np.uint8), [8])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([1, 2, 3]), pa.array([item, None, f"{item} {item}"])], ["_id", "_body", "_text"])
    out = pa.Table.from_batches(list(scan[0](iter([batch]))))
    assert len(calls) == 2
    assert out.column("_id").to_pylist() == [1] * 6 + [3] * 19
