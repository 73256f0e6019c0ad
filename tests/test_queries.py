"""Every registered query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as driver

from conftest import SF
from vintora.registry.catalog import ALL

QUERIES = {name: run for name, run in driver.queries().items() if name in ALL}
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name in ALL}
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages"
          " benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = ordered(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = ordered(tuple(plain(row[i]) for i in at) for row in result.fetchall())
    assert got == expected
