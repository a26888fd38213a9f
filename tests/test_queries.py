"""Every query of the library against its DuckDB oracle."""

import math

import duckdb
import pytest

from tokenforge import queries as Q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    return v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_like_oracle(spark, sf, duck, name):
    df = Q.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    r = duck.execute(Q.oracle_sql()[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(plain(dict(zip(names, x, strict=True))[c]) for c in columns) for x in r.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["tokens"] and df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
