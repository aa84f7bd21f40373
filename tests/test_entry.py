"""The driver contract, and every registered query against its DuckDB twin."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from silverline.plans.queries import QUERIES
from silverline.sources.tables import TABLES
from tests.conftest import SF_SMOKE


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9)
    return v


def _rows(df):
    cols = sorted(df.columns)
    return sorted(
        (tuple(_norm(v) for v in row) for row in df[cols].itertuples(index=False, name=None)),
        key=repr,
    )


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    yield con
    con.close()


def test_entry_runs_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "video_id" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) & set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, duck, name):
    got = entry.queries()[name](spark, SF_SMOKE).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)
