"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(x):
        if pd.isna(x):
            return "NULL"
        return f"{x:.5f}" if isinstance(x, float) else str(x)

    ordered = df[sorted(df.columns)]
    return sorted(tuple(plain(x) for x in r) for r in ordered.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, FOLDER).toPandas()
    if name not in ORACLES:
        assert len(result) > 0
        return
    expected = duck.execute(ORACLES[name]).df()
    assert sorted(result.columns) == sorted(expected.columns)
    assert rows(result) == rows(expected)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    out = entry_points.entry(spark)
    assert out.columns == ["tier", "reason", "strings", "tokens"]
    assert out.count() > 0
