"""Every core query against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from tamarin import queries as m
from tamarin import queries_io as io

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def shown(v):
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if v is None or isinstance(v, float) and math.isnan(v):
        return "None"
    return f"{v:.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows(columns, values):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted(tuple(shown(r[i]) for i in order) for r in values)


def compare(spark, query, sql):
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = query(spark, DATA)
    x = con.execute(sql)
    assert rows(df.columns, df.collect()) == rows([c[0] for c in x.description], x.fetchall())


@pytest.mark.parametrize("name", sorted(m.ORACLES))
def test_sql(spark, name):
    compare(spark, m.QUERIES[name], m.ORACLES[name])


@pytest.mark.parametrize("name", sorted(io.ORACLES))
def test_io_sql(spark, name):
    compare(spark, io.QUERIES[name], io.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(m.QUERIES) - set(m.ORACLES)))
def test_runs(spark, name):
    df = m.QUERIES[name](spark, DATA)
    assert df.columns and len(df.columns) == len(set(df.columns)) and df.count() > 0


def test_scans_are_pruned(spark):
    plan = m.token_top(spark, DATA)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<target_gcf:string>" in plan


def test_entry_needs_no_llm():
    import __spark_entry__ as e

    assert set(m.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
