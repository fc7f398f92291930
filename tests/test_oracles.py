"""Every query that SQL can express, against DuckDB over the same tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from tileweave import registry

SF = os.environ.get("TILEWEAVE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def cell(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and np.isnan(v)):
        return "null"
    if isinstance(v, (bool, np.bool_, str)):
        return str(v)
    if isinstance(v, (list, np.ndarray)):
        return str([cell(x) for x in v])
    x = float(v)
    return str(int(x)) if x == int(x) else f"{x:.6f}"


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted(tuple(map(cell, r)) for r in pdf.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_duckdb(spark, duck, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), duck.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(want) and rows(got) == rows(want)
