"""Every SQL-checked query equals its DuckDB oracle at sf0.001."""
import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

ORACLE = E.oracle_sql()


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(None if (isinstance(x, float) and math.isnan(x)) else x for x in r))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def _close(a, b):
    if isinstance(a, float) and isinstance(b, (int, float)):
        return a == b or abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    return a == b


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    s = _norm([tuple(r[c] for c in order) for r in df.collect()])
    idx = [rel.columns.index(c) for c in order]
    d = _norm([tuple(r[i] for i in idx) for r in rel.fetchall()])
    assert len(s) == len(d)
    for r1, r2 in zip(s, d):
        assert all(_close(x, y) for x, y in zip(r1, r2)), (r1, r2)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 3
    assert set(df.columns) >= {"segment", "n", "median_price"}
