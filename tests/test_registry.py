"""Every registered analysis against its SQL, on the small tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from strutwise.plans import registry


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS FROM '{f}'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    shown = (tuple(None if x is pd.NA or x is None or x != x else str(x) for x in r) for r in frame.itertuples(index=False))
    return sorted(shown, key=str)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows(spark, sf, duck, name):
    got, want = registry.QUERIES[name](spark, sf).toPandas(), duck.sql(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_flagship_is_registered():
    assert registry.FLAGSHIP in registry.QUERIES
