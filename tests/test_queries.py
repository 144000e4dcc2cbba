"""Every query with an SQL text gives exactly its rows, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import TABLES, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, TEXTS = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return connection


def test_every_text_has_a_query():
    assert set(TEXTS) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 6


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_same_as_sql(spark, db, name):
    assert difference(QUERIES[name](spark, FOLDER).toPandas(), db.execute(TEXTS[name]).df()) == ""
