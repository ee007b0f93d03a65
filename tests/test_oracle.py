"""Every registered query against its SQL oracle (DuckDB) on the small
tables: row count, column names, and values."""
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from cumulus.plans.catalog import QUERIES
from cumulus.sources.tables import TABLES


def _canon(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return int(v) if v.is_integer() else round(v, 6)
    if hasattr(v, "isoformat"):
        if hasattr(v, "hour") and (v.hour, v.minute, v.second, v.microsecond) == (0, 0, 0, 0):
            return v.date().isoformat()
        return v.isoformat()
    if hasattr(v, "item"):
        return _canon(v.item())
    return v


def _rows(df):
    cols = sorted(df.columns)
    out = [tuple(_canon(x) for x in r) for r in df[cols].itertuples(index=False)]
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    got = E.queries()[name](spark, sf_small).toPandas()
    exp = con.sql(E.oracle_sql()[name]).df()  # every query of the reference's operators has one
    assert _rows(got) == _rows(exp)
