"""Every registered query against its SQL, and the shape of the plans."""

import os
import re
import sys

import duckdb
import pytest

from tierflow.catalog import ORACLES, QUERIES
from tierflow.catalog.registry import Tables
from tierflow.catalog.views import BASE_TABLES

FOLDER = "/root/testdata/sf0.001"
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check import table  # noqa: E402


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in BASE_TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_result_equals_the_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    assert got == table(names, result.fetchall()) and got
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|EvalPython|InPandas|MapInArrow", plan)


def test_views_keep_every_row_of_their_base_tables(spark):
    t = Tables(spark, FOLDER)
    same = {"customers": "customer", "accounts": "orders", "transactions": "lineitem", "trips": "lineitem",
            "credit_bureau_reports": "events", "payment_gateway_logs": "events", "gw_transactions": "orders",
            "encounters": "lineitem", "patients": "customer", "hospitals": "supplier", "physicians": "supplier",
            "departments": "part", "balance_rows": "lineitem", "run_events": "events", "registry_rows": "supplier",
            "branches": "nation"}
    for view, base in same.items():
        assert getattr(t, view).count() == getattr(t, base).count(), view


def test_only_needed_columns_are_read(spark):
    plan = QUERIES["risk_customer_summary"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in plan
    plan = QUERIES["bounded_slice"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in plan and "LessThanOrEqual(o_orderdate" in plan


def test_declared_schemas_are_those_of_the_files(spark):
    from tierflow.catalog.views import SCHEMAS
    for name, ddl in SCHEMAS.items():
        declared = spark.read.schema(ddl).parquet(f"{FOLDER}/{name}.parquet")
        assert declared.dtypes == spark.read.parquet(f"{FOLDER}/{name}.parquet").dtypes, name
