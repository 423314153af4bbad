"""Every query with SQL gives what DuckDB gives on the smallest tables; a few also with another partitioning."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from twinfold.plans import registry
from twinfold.plans.inputs import BASE

SF = "/root/testdata/sf0.001"


def plain(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
            return "null"
        if isinstance(v, (float, np.floating)):  # a nullable integer is a float in one frame and an integer in the other
            return str(int(v)) if float(v).is_integer() else repr(round(float(v), 6))
        return str(int(v)) if isinstance(v, (int, np.integer)) and not isinstance(v, bool) else str(v)

    columns = sorted(df.columns)
    return columns, sorted(tuple(one(v) for v in row) for row in df[columns].astype(object).itertuples(index=False))


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in BASE:
        path = f"{SF}/{t}.parquet"
        con.sql(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, duck, name):
    assert plain(registry.QUERIES[name](spark, SF).toPandas()) == plain(duck.sql(registry.ORACLES[name]).df())


def test_every_query_has_sql():
    assert not set(registry.QUERIES) - set(registry.ORACLES)


@pytest.mark.parametrize("name", ["block_diff", "order_plan", "quota_usage", "pack_batches", "failure_streaks", "outage_state", "rate_limited_window"])
def test_partitioning_makes_no_difference(spark, name):
    found = []
    for n in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(plain(registry.QUERIES[name](spark, SF).toPandas()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1]
