"""Every registered query against its SQL, and the shape of its plan."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as driver
from kpiloom.catalog.registry import ORACLE, QUERIES
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not there")

DUCK_TYPES = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    sql = ORACLE[name]
    df = QUERIES[name](spark, SF_DIR)
    types = {row[0]: DUCK_TYPES.get(row[1], row[1]) for row in con.execute("DESCRIBE " + sql).fetchall()}
    assert dict(df.dtypes) == types
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|\bWindow\b|EvalPython|MapInPandas", plan)
    assert compare(df, con, sql) == []


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[:3] == ["eCom_Store_ID", "Transaction_Nbr", "Order_Date"]
    assert not df.isEmpty()
