"""Every registered query against its SQL twin, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from gapwise.plans.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SLOW = {f"model_{v}" for v in ("scaled_drop", "scaled_keep", "drop_missing", "sparse")}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_equals_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, FOLDER)
    done = duck.execute(entry_module.oracle_sql()[name])
    want = rows_of([d[0] for d in done.description], done.fetchall())
    assert rows_of(df.columns, df.collect()) == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["k", "priority_index", "price_norm", "cust_norm"]
