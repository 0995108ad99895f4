"""Every registered query against its SQL on the small tables."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

from tarn.plans import registry

SF = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return tuple(norm(x) for x in v) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    mine = [tuple(norm(r[c]) for c in cols) for r in df.collect()]
    rel = duck.sql(SQL[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    theirs = [tuple(norm(r[i]) for i in at) for r in rel.fetchall()]
    key = lambda r: tuple((v is None, str(v)) for v in r)
    a, b = sorted(mine, key=key), sorted(theirs, key=key)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert all(p == q or (isinstance(p, float) and isinstance(q, float) and abs(p - q) <= 2e-5 * max(1, abs(p))) for p, q in zip(x, y, strict=True)), (x, y)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(SQL)))
def test_query_runs(spark, name):
    df = registry.queries()[name](spark, SF)
    n, bounds = df.count(), {"html_tables": (0, 10**6), "fingerprint": (1, 100), "calibration_bins": (1, 100)}
    lo, hi = bounds.get(name, (1, 10**6))
    assert len(df.columns) > 1 and lo <= n <= hi
    shares = [c for c, t in df.dtypes if t == "double" and (c.startswith("p_") or c in ("accuracy", "auc"))]
    for c in shares:  # probabilities and rates stay within their range
        assert df.filter(f"{c} < -1e-9 or {c} > 1 + 1e-9").count() == 0, c
