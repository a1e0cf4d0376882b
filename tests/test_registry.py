"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from workload import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def plain(frame):
    def value(x):
        if x is None or x is pd.NA or x != x:
            return None
        return x.item() if hasattr(x, "item") else x

    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(value, row)) for row in frame.itertuples(index=False)), key=str)


def test_all_are_listed():
    assert registry.QUERIES.items() <= entry.queries().items()
    assert registry.ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    expected = duck.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert plain(got) == plain(expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
