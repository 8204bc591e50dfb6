"""Every query against its SQL, and what its plan must and must not hold."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registry
from rankmatch.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def comparable(df):
    df = df[sorted(df.columns)]
    text = {
        c: ["null" if pd.isna(v) else str(int(v)) if isinstance(v, (int, float)) else str(v) for v in df[c]]
        for c in df.columns
    }
    return sorted(zip(*text.values()))


# The text queries have tests of their own.
NAMES = sorted(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql_and_has_a_distributed_plan(spark, sql, name):
    df = registry.queries()[name](spark, SMALL)
    want = sql.execute(registry.oracle_sql()[name]).df()
    assert sorted(df.columns) == sorted(want.columns)
    assert comparable(df.toPandas()) == comparable(want)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan
    assert "Window" not in plan or "WindowGroupLimit" in plan


def test_registry_is_complete(spark):
    assert set(NAMES) <= set(registry.queries()) and set(NAMES) <= set(registry.oracle_sql())
    assert registry.entry(spark).columns == registry.queries()["q_all_matches"](spark, SMALL).columns


def test_scans_read_only_what_they_need(spark):
    plan = registry.queries()["q_anti"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan
    plan = registry.queries()["q_map_category"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan
