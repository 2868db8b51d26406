"""Every query with an SQL twin gives the same rows on the smallest tables."""

import math

import pytest

import __spark_entry__ as entry
from tests.conftest import SF

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(cell(r[k]) for k in order) for r in rows)


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cur = duck.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert table(df.columns, df.collect()) == table(names, cur.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
