"""Every query: the SQL counterpart, and the shape of its plan."""

from __future__ import annotations

import importlib
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, difference
from membervane.catalog.oracle import all_oracles
from membervane.catalog.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not there")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def test_every_query_has_a_counterpart():
    assert all_queries().keys() == all_oracles().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert all_queries().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", all_queries())
def test_query(spark, db, name):
    df = all_queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan
    rows = df.toPandas()
    assert difference(rows, db.sql(all_oracles()[name]).df()) is None


def test_text_part_is_optional(monkeypatch):
    """Without the pipeline or the text operators the other queries are still registered."""
    core = all_queries().keys()
    for missing in ("corpus_pipeline", "membervane.llm", "xxhash", "ahocorasick"):
        with monkeypatch.context() as m:
            for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("membervane.llm")]:
                m.delitem(sys.modules, name)
            m.setitem(sys.modules, missing, None)
            bare = importlib.reload(entry)
            assert bare.queries().keys() == core and bare.oracle_sql().keys() == all_oracles().keys()
    importlib.reload(entry)


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "member_id"
