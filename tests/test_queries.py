"""Every registered query against its SQL check on the smallest tables."""

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry
from check import TABLES, same, table

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, SMALL)
    columns, got = table(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        assert got
        return
    cursor = connection.execute(ORACLES[name])
    names, want = table([d[0] for d in cursor.description], cursor.fetchall())
    assert columns == names
    assert len(got) == len(want)
    assert all(same(x, y) for g, w in zip(got, want) for x, y in zip(g, w))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
