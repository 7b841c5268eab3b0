"""Every query with an oracle must agree with DuckDB on the smallest tables."""

import os

import pytest

from fareflow.plans.checks import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, db, name):
    found = QUERIES[name](spark, DATA)
    cursor = db.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    expected = canonical(columns, cursor.fetchall())
    got = canonical(found.columns, [tuple(r) for r in found.collect()])
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
