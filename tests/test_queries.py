"""Every query with a check statement, against the other engine on the smallest data."""

from __future__ import annotations

import duckdb
import pytest
from check_queries import TABLES, canon, kinds

import __spark_entry__ as entry_module

ORACLE = entry_module.oracle_sql()
QUERIES = entry_module.queries()
# No Python in the plan, no cross joins.
BANNED = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin")


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in BANNED:
        assert banned not in plan
    rows = [tuple(r) for r in df.collect()]
    relation = con.sql(ORACLE[name])
    columns, expected = list(relation.columns), relation.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert kinds(df.columns, rows) == kinds(columns, expected)
    assert canon(df.columns, rows) == canon(columns, expected)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
