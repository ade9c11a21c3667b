"""Queries of this folder against their SQL twins on small tables."""

import corpus_pipeline
import duckdb
import pytest

from check import TABLES, rows_of
from lodestone.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_twin(spark, db, name):
    df = queries.queries()[name](spark, SF)
    found = db.execute(queries.oracle_sql()[name])
    theirs = rows_of([d[0] for d in found.description], found.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in found.description) and len(theirs) > 0
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == theirs


def test_twins_are_of_registered_queries():
    assert queries.oracle_sql().keys() <= queries.queries().keys() and corpus_pipeline.ORACLE_SQL is None
