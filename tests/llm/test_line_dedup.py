"""Line dedup on planted passages and odd rows; its SQL is compared with the other queries'."""

import random

from culprit.llm import line_dedup

SCHEMA = "doc_id long, text string, n_chunks string, _id string, _lines string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA)


def cleaned(spark, rows):
    return [(r.doc_id, r.text, r.n_chunks, r.n_removed) for r in line_dedup.remove_repeats(frame(spark, rows)).collect()]


def test_long_passages_leave_all_but_their_first_place(spark, prose):
    passage = prose(60, 1)
    rows = [(i, f"{prose(9, 10 * i)}\n{passage}\n{prose(8, 10 * i + 1)}") for i in range(30)]
    got = {r[0]: r for r in cleaned(spark, rows)}
    assert passage in got[0][1]
    assert all(passage not in got[i][1] and got[i][3] == 1 for i in range(1, 30))
    assert all(got[i][1] == rows[i][1].replace(passage + "\n", "") for i in range(1, 30))


def test_shifted_blocks_of_lines_are_found(spark, prose):
    block = [prose(5, 100 + i) for i in range(40)]
    rows = [(i, "\n".join([*(prose(4, 1000 * i + k) for k in range(i)), *block])) for i in range(12)]
    left = {r[0]: r[1] for r in cleaned(spark, rows)}
    for i in range(1, 12):
        kept = sum(line in left[i].split("\n") for line in block)
        assert kept <= len(block) / 3, kept  # single-line chunks and those at the edge stay
        assert all(prose(4, 1000 * i + k) in left[i] for k in range(i))


def test_long_passages_in_lines_of_any_length_go(spark, prose):
    for words in (6, 15, 25, 45):
        passage = [prose(words, 50 * words + i) for i in range(240 // words)]
        rows = [(i, "\n".join([prose(30, 7000 + i), *passage, prose(30, 9000 + i)])) for i in range(20)]
        left = {r[0]: r[1].split("\n") for r in cleaned(spark, rows)}
        assert left[0] == rows[0][1].split("\n")
        kept = [sum(line in left[i] for line in passage) / len(passage) for i in range(1, 20)]
        assert sum(kept) / len(kept) < 0.5, (words, kept)
        assert all(left[i][0] == prose(30, 7000 + i) and left[i][-1] == prose(30, 9000 + i) for i in range(1, 20))


def test_short_lines_that_many_share_stay(spark, prose):
    rows = [(i, f"{prose(20, i)}\n{prose(30, -1)}\n{prose(20, 100 + i)}") for i in range(20)]
    assert sorted(r[:2] for r in cleaned(spark, rows)) == rows


def test_runs_pass_over_blank_lines(spark, prose):
    lines = [prose(20, 400 + i) for i in range(60)]
    rows = [(i, "\n\n".join(lines)) for i in range(2)]
    left = {r[0]: r[1] for r in cleaned(spark, rows)}
    assert left[0] == rows[0][1]
    assert not left[1].strip()


def test_clean_documents_are_unchanged(spark, prose):
    draw = random.Random(3)
    rows = [(i, "\n".join(prose(draw.randint(1, 70), 100 * i + k) for k in range(6)) + f"\n{prose(4, -1 - i)}\nshort line") for i in range(40)]
    assert sorted(r[:2] for r in cleaned(spark, rows)) == rows


def test_odd_rows(spark, prose):
    passage = prose(60, 5)
    rows = [(None, passage), (None, passage), (3, passage), (3, passage), (4, f"{passage}\n{passage}"), (5, None), (6, ""), (7, "\n\n\n"), (8, "\n\n\n")]
    rows += [(9, "\n".join([passage] * 5_000)), (None, prose(55, 6)), (None, prose(55, 6) + "\n" + prose(55, 6))]
    got = sorted(cleaned(spark, rows), key=str)
    lone = prose(55, 6)
    want = [(None, "", 1, 1)] * 2 + [(3, passage, 1, 0)] * 2 + [(4, "", 2, 2), (5, None, 1, 0), (6, "", 1, 0)]
    want += [(9, "", 5_000, 5_000), (None, lone, 1, 0), (None, lone, 2, 1)]
    assert [r for r in got if r[0] not in (7, 8)] == sorted(want, key=str)
    assert [r[1:2] + r[3:] for r in got if r[0] in (7, 8)] == [("\n\n\n", 0)] * 2


def test_empty_table(spark):
    out = line_dedup.remove_repeats(frame(spark, []))
    assert out.count() == 0
    assert out.columns == ["doc_id", "text", "_id", "_lines", "n_chunks", "n_removed"]
