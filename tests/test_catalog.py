"""Every registered query against its DuckDB twin, over whole tables."""

import glob
import math
import os

import duckdb
import pytest

from voxloom import catalog

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else v


def rows_of(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, db, name):
    df, want = QUERIES[name](spark, SF), db.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    kinds = dict(zip(want.columns, map(str, want.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and len(df.collect()) > 0


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)
