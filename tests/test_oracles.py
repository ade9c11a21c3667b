"""Every query of the library's own operators against its SQL twin on the smallest tables."""

import os
import re

import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of
from lodestone.plans.oracles import oracles
from lodestone.plans.registry import registry

SF = entry.SMOKE_DIR
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert registry().keys() == oracles().keys()
    assert registry().keys() <= entry.queries().keys() and oracles().items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_equals_its_twin(spark, db, name):
    df = registry()[name](spark, SF)
    found = db.execute(oracles()[name])
    theirs = rows_of([d[0] for d in found.description], found.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in found.description)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == theirs


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["query_id", "prompt"] and df.count() > 0


@pytest.mark.parametrize("name", ["build_elements", "knn_join", "knn_join_blocks", "build_prompts", "crawl_frontier", "history_prompts"])
def test_no_cross_joins_and_no_single_task(spark, name):
    plan = registry()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Exchange SinglePartition", plan)


def test_page_extraction_does_not_shuffle(spark):
    from lodestone.operators.elements import build_elements
    from lodestone.operators.pages import page_links, page_text

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for df in (build_elements(pages), page_links(pages), page_text(pages)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("FileScan parquet") == 1
        assert "ReadSchema: struct<url:string,html:string>" in plan
