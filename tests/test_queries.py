"""Every registered query against its SQL statement, at the smallest scale."""

from __future__ import annotations

import os
import re
import subprocess
import sys

import duckdb
import pytest
from conftest import plan_of

import __spark_entry__ as entry
from sprintmart.queries import ORACLES, QUERIES
from sprintmart.queries.registry import TABLES
from tools.check import rows_of

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_query_has_its_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cur.fetchall())
    plan = plan_of(df)
    assert not re.search(r"EvalPython|InPandas|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_a_missing_library_leaves_only_the_corpus_queries_out():
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; print(*e.queries())"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert set(QUERIES) == set(done.stdout.split())
