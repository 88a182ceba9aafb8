"""Every registered query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from palaver.plans import ORACLE, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, (list, tuple, np.ndarray)):
        return [plain(x) for x in v]
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, float, np.number)):
        return None if math.isnan(v) else round(float(v), 6)
    return str(v)


def rows(df: pd.DataFrame) -> list[str]:
    return sorted(repr([plain(v) for v in r]) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, duck, name):
    mine = QUERIES[name](spark, sf_dir).toPandas()
    theirs = duck.sql(ORACLE[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() >= 0
