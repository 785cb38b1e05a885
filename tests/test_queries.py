"""Every query against its SQL on the small tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

from palaver.plans import further, more, registry, scale  # noqa: F401

FOLDER = "/root/testdata/sf0.01"


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    return x


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(x) for x in r) for r in df.select(*columns).collect())
    assert got
    if name in registry.ORACLE:
        rel = duck.sql(registry.ORACLE[name])
        assert sorted(rel.columns) == columns
        want = Counter(tuple(plain(x) for x in r) for r in rel.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall())
        assert got == want, list((got - want).items())[:2] + list((want - got).items())[:2]
