"""Every query against its DuckDB answer, rows as a bag; no plan pairs rows without a key."""

from __future__ import annotations

import glob
import os
import re
from decimal import Decimal

import duckdb
import pytest

from testbed.oracle import SELECTS, oracle_sql
from testbed.queries import QUERIES, queries

TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def plain(value):
    return repr(float(value)) if isinstance(value, (float, Decimal)) else str(value)


def test_every_query_has_an_answer():
    assert SELECTS.keys() == QUERIES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoopJoin|Python|Pandas", plan)
    columns = sorted(df.columns)
    answer = duck.execute(oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in answer.description}
    assert types == {c: TYPES[t] for c, t in df.dtypes}
    order = [list(types).index(c) for c in columns]
    expected = sorted(tuple(plain(row[i]) for i in order) for row in answer.fetchall())
    got = sorted(tuple(plain(v) for v in row) for row in df.select(columns).collect())
    assert got == expected
    assert got or name == "reject_report"
