"""Every query with SQL gives DuckDB's rows on the smallest tables; the others run."""

import math
import os

import pytest

import __spark_entry__ as entry
from ledgerlake.plans import registry

FOLDER = "/root/testdata/sf0.001"


def cell(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}") if math.isfinite(v) else v
    return v if isinstance(v, (str, bool)) else float(v) if isinstance(v, int) else str(v)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"create view {f[:-8]} as select * from '{FOLDER}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, FOLDER)
    got = df.collect()
    if name not in registry.ORACLES:
        return
    cur = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    cols = sorted(names)
    want = sorted(([cell(r[names.index(c)]) for c in cols] for r in cur.fetchall()), key=str)
    assert sorted(([cell(r[c]) for c in cols] for r in got), key=str) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
