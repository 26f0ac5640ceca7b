"""Every registered query against its SQL on the small tables."""

import os
from decimal import Decimal

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as driver

FOLDER = os.environ.get("TENURE_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{FOLDER}/{f}'")
    return con


def plain(x):
    if isinstance(x, list):
        return str(x)
    if pd.isna(x):
        return None
    if isinstance(x, (bool, np.bool_)):
        return str(x)
    if isinstance(x, (int, float, Decimal, np.number)):
        return f"{float(x):.10g}"
    return str(x).replace(" 00:00:00", "")


def table(df, columns):
    return sorted((tuple(plain(x) for x in r) for r in df[columns].itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER).toPandas()
    theirs = duck.execute(SQL[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    assert table(ours, columns) == table(theirs, columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
