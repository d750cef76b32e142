"""Every query with an oracle against its SQL on the smallest data set."""

import os

import pandas as pd
import pytest

import __spark_entry__ as entry_points

duckdb = pytest.importorskip("duckdb")
SMALL = entry_points.SMALL_DIR
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test data not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(os.listdir(SMALL)):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{file}'")
    return con


def normal(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        known = df[c].dropna()
        if df[c].dtype == object and len(known) and hasattr(known.iloc[0], "isoformat"):
            df[c] = pd.to_datetime(df[c])
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]")
    return df.sort_values(list(df.columns), na_position="last").reset_index(drop=True)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert len(df.columns) == 49 and "sales_quantity_rolling_90_median" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    relation = duck.sql(ORACLES[name])
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(relation.columns, map(str, relation.types)))
    mine, theirs = normal(df.toPandas()), normal(relation.df())
    assert len(mine) == len(theirs)
    for c in mine.columns:
        same = (mine[c] == theirs[c]) | (mine[c].isna() & theirs[c].isna())
        assert same.all(), f"{c}: {(~same).sum()} of {len(same)} differ"


@pytest.mark.parametrize("name", ["batch_training", "additive_forecast", "boosted_trees"])
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
