"""Every registered query of the library runs on the smallest tables and, where it has SQL, gives the same rows as DuckDB."""

import glob
import math
import numbers
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from fluxgrain.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(x):
    if isinstance(x, list | np.ndarray):
        return [plain(y) for y in x]
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool | np.bool_):
        return bool(x)
    return float(x) if isinstance(x, numbers.Number) else str(x)


def rows(df):
    return sorted(repr([plain(x) for x in r]) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    got = registry.QUERIES[name](spark, DATA).toPandas()
    if name in registry.ORACLES:
        want = con.sql(registry.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
