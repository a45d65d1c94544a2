"""Every registered query of the engine against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from ligandry.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(float(r[i]) + 0.0) if isinstance(r[i], float) else repr(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name in ORACLE_SQL:
        found = con.execute(ORACLE_SQL[name])
        columns = [c[0] for c in found.description]
        assert sorted(columns) == sorted(df.columns)
        assert plain(got, df.columns) == plain(found.fetchall(), columns)
    else:
        assert got


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
