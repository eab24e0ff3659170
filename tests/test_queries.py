"""Every query of the library against its SQL twin, at the smallest scale."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from prairie import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}") + 0.0
    return value


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(plain(row[i]) for i in order)) for row in values)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


def test_every_twin_has_a_query():
    assert SQL.keys() <= QUERIES.keys() and len(QUERIES) > 110


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 10
