"""Every query with SQL of its own gives the same rows in a second engine."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from lodestone.plans.oracles import ORACLES
from lodestone.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for p in glob.glob(f"{small}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.fixture(scope="module")
def small():
    return "/root/testdata/sf0.001"


def plain(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if pd.isna(v):
            return "~"
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(round(v, 6) if isinstance(v, float) else v)

    return sorted(tuple(cell(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, small, name):
    got, want = QUERIES[name](spark, small).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_others_run(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
