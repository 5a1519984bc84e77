"""Every registered query against its plain SQL on the given tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for name in os.listdir(SF_DIR):
        db.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    return db


def canonical(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    cells = df.apply(lambda c: pd.to_datetime(c).astype("datetime64[us]").astype(str)
                     if pd.api.types.is_datetime64_any_dtype(c) else c.astype(str))
    return sorted(map(tuple, cells.to_numpy()))


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    if name not in SQL:
        assert len(got) > 0
        return
    want = con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry(spark):
    assert contract.entry(spark).columns == ["window_end", "rank", "item_id", "cnt"]
