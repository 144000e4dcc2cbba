import random
import zlib

import duckdb
import numpy as np
import pytest

from culprit.llm import spelling
from culprit.llm.queries import op11_spelling


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def lexicon(words):
    return spelling.Lexicon(words, np.unique(np.frombuffer("".join(words).encode("utf-32-le"), "<u4")))


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghijklmnop"])
def test_search_finds_every_near_word_of_each_half(letters):
    draw = random.Random(letters)
    words = sorted({"".join(draw.choice(letters) for _ in range(draw.randint(6, 9))) for _ in range(250)})
    index = lexicon(words)
    for right in (True, False):
        found = {(words[a], words[b]) for a, b in zip(*index.near(words, right))}
        halves = {u: len(u) // 2 for u in words}
        agree = lambda u, v: v.startswith(u[: halves[u]]) if right else v.endswith(u[halves[u] :])
        assert found == {(u, v) for u in words for v in words if one_edit(u, v) and agree(u, v)}


def test_one_word_and_a_very_long_one():
    assert not len(lexicon(["secret"]).near(["secret"], True)[0])
    long = "abcde" * 3000
    index = lexicon([long, long[:9000] + "x" + long[9000:], "abcdef"])
    assert len(index.near([long], True)[0]) == 1 and not len(index.near([long], False)[0])


def plain_variants(docs):
    counts = {}
    for key, text in docs:
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for run in "".join(c if c in "abcdefghijklmnopqrstuvwxyz" or "À" <= c <= "ÿ" else " " for c in text).split():
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= 5}
    near = {w: [v for v in counts if v != w and one_edit(w, v)] for w in counts}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best and counts[best] >= 5 * counts[w] else None

    def root(w):
        while forms[w]:
            w = forms[w]
        return w

    return {(w, forms[w], root(w), n, len(near[w]), counts.get(forms[w])) for w, n in counts.items()}


@pytest.fixture
def odd_documents():
    draw = random.Random(5)
    common = ["planet", "garden", "letter", "naïveté", "straße", "aaaaaa"]
    out = [(i, " ".join(draw.choice(common) for _ in range(60))) for i in range(40)]
    typos = ["plannet", "plamet", "planets", "gardan", "garrden", "aaaaaaa", "aaaaaaaa", "PLANET", "ĂPLANET", "leter", "lettter"]
    out += [(1000 + i, " ".join(typos)) for i in range(7)]
    return [*out, (None, None), (None, "planet, planet"), (7, ""), (8, "x" * 200_000), (9, "x" * 199_999), out[0], out[0]]


def test_equals_plain_counting(spark, odd_documents):
    df = spark.createDataFrame(odd_documents, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS n", "3 AS form", "4 AS shard")
    got = {tuple(r) for r in spelling.variants(df).collect()}
    assert got == plain_variants(odd_documents)


def test_crowded_indexes_are_cut_and_lose_nothing(spark):
    draw = random.Random(3)
    # A third of all words share their first half, another third their second.
    ends = {"".join(draw.choice("abcd") for _ in range(4)) for _ in range(120)}
    words = {f"same{e}" for e in ends} | {f"{e}tail" for e in ends} | {"".join(draw.choice("abc") for _ in range(7)) for _ in range(100)}
    rows = [(w, draw.randint(5, 500)) for w in sorted(words)]
    got = spelling.near_words(spark.createDataFrame(rows, "word string, n long"), index_words=16)
    counts, expected = dict(rows), {}
    for u in counts:
        others = [v for v in counts if v != u and one_edit(u, v)]
        if others:
            best = min(others, key=lambda v: (-counts[v], v))
            expected[u] = (len(others), counts[best], best)
    assert {r["word"]: (r["n_near"], r["form_n"], r["form"]) for r in got.collect()} == expected


def test_empty_table(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
        expected = {tuple(r) for r in con.sql(f"SELECT word, form, root, n, n_near, form_n FROM ({spelling.ORACLE_SQL})").fetchall()}
    got = {tuple(r) for r in op11_spelling(spark, folder).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == expected and any(r[1] for r in got)
