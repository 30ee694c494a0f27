"""Every registered query against its DuckDB SQL at sf0.001 (the same
check the driver runs at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from quarry.sources.tables import TABLES

SQL = E.oracle_sql()
QUERIES = {k: v for k, v in E.queries().items() if k.startswith("q_")}  # the optional part has tests of its own


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr([r[i] for i in order]) for r in rows)


def test_every_query_has_oracle():
    assert set(QUERIES) == {k for k in SQL if k.startswith("q_")}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "content" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    norm = lambda v: v.isoformat() if hasattr(v, "isoformat") else v
    assert canon(df.columns, [tuple(map(norm, r)) for r in srows]) == canon(dcols, [tuple(map(norm, r)) for r in drows])
