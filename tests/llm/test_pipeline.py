"""Each stage of the pipeline on what its predecessor kept, against plain computations."""

from itertools import combinations

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from culprit.llm import decontaminate, line_dedup, mixture, simhash
from culprit.llm.common import kept_table

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """The input of every stage and the result of the last."""
    out = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(kept_table(stage(spark, out[-1], FOLDER), name))
    return out


def by_sql(text, docs):
    db = duckdb.connect()
    db.register("documents", docs.select(COLUMNS).toArrow())
    return sorted(db.execute(text).fetchall(), key=str)


def texts(docs):
    return dict(docs.select("doc_id", "text").collect())


def test_columns_are_kept(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "mixture"]
    assert all(s.columns == COLUMNS for s in steps[:-1])
    assert all(s.select("n_chars").dtypes == [("n_chars", "bigint")] for s in steps[:-1])


def test_rejected_documents_go_and_clean_ones_stay(spark, steps):
    marks = dict(spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality").collect())
    kept = texts(steps[1])
    whole = texts(steps[0])
    assert all(whole[i] == t for i, t in kept.items())
    good, bad = ([i in kept for i, q in marks.items() if q == want] for want in (1, 0))
    assert np.mean(good) > 0.98
    assert np.mean(bad) < 0.1


def test_line_dedup_equals_its_sql(steps):
    want = [(r[0], r[1]) for r in by_sql(line_dedup.ORACLE_SQL, steps[1])]
    assert sorted(texts(steps[2]).items(), key=str) == want
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_near_copies_equal_all_pairs(steps):
    docs = texts(steps[2])
    prints = {i: simhash.fingerprint(t.encode()) for i, t in docs.items()}
    group = {i: i for i in docs}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in combinations(sorted(docs), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = root(a), root(b)
            group[max(x, y)] = min(x, y)
    want = {i: docs[i] for i in docs if root(i) == i}
    assert len(want) < len(docs)
    assert texts(steps[3]) == want


def test_benchmark_questions_go(spark, steps):
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    items = [f" {' '.join(r.text.split())} " for r in benchmark]
    before, after = texts(steps[3]), texts(steps[4])
    holding = {i for i, t in before.items() if any(q in f" {' '.join(t.split())} " for q in items)}
    assert holding and not holding & set(after)
    lost = set(before) - set(after)
    assert len(lost - holding) <= 0.3 * len(holding) + 2
    assert decontaminate.COVERAGE == 0.5


def test_mixture_equals_its_sql(steps):
    got = steps[5].select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, got), key=str) == by_sql(mixture.ORACLE_SQL, steps[4])


def test_run_is_registered_and_empty_tables_pass(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.queries()["pipeline"](spark, str(tmp_path)).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None
