"""Every registered query against its DuckDB oracle on the smallest tables."""
import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

ORACLE = E.oracle_sql()
NAMES = sorted(ORACLE)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_is_registered_with_entry():
    qs = E.queries()
    assert set(ORACLE) <= set(qs)
    assert len(qs) >= 80


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _rows(df.columns, rows) == _rows(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "trip_duration_min" in df.columns
