"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from workbench import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def canon(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(repr(r[i]) for i in order) for r in records])


def test_each_query_has_sql():
    assert set(catalogue()) <= set(contract.queries()) & set(contract.oracle_sql()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalogue()))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in plan for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"))
    cur = duck.execute(contract.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(cur.fetchall(), names)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "NUM_ITEM" in df.columns
