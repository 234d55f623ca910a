"""Every registered query of the library against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def plain(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return "null" if isinstance(v, float) and math.isnan(v) else repr(round(float(v), 6) + 0.0)
    return str(v)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    got = entry.queries()[name](spark, SF)
    rows = sorted(tuple(plain(r[c]) for c in sorted(got.columns)) for r in got.collect())
    if name not in entry.oracle_sql():
        assert rows
        return
    want = db.sql(entry.oracle_sql()[name])
    assert sorted(want.columns) == sorted(got.columns)
    order = [want.columns.index(c) for c in sorted(want.columns)]
    assert rows == sorted(tuple(plain(r[i]) for i in order) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_scans_read_only_what_is_asked(spark):
    plan = entry.queries()["total_gate"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
