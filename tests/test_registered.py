"""Every registered query against its SQL, run by DuckDB over the same files."""

import duckdb
import pytest

import __spark_entry__ as registered

SQL = registered.oracle_sql()
# Queries of the corpus part, where it is there, have tests of their own.
QUERIES = {name: query for name, query in registered.queries().items() if name in registered._QUERIES | registered._ODD_QUERIES}

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


def test_every_query_has_sql():
    assert QUERIES.keys() <= SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = sorted(repr(tuple(row)) for row in frame.select(*columns).collect())
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW events AS FROM '{sf_dir}/events.parquet'")
        found = db.sql(SQL[name])
        types = dict(zip(found.columns, map(str, found.types)))
        want = sorted(repr(row) for row in found.select(*columns).fetchall())
    assert got == want and len(got) > 30
    assert types == {c: TYPES.get(t, t.upper()) for c, t in frame.dtypes}


def test_entry(spark):
    assert len(registered.entry(spark).columns) == 25
