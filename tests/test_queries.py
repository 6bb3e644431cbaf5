"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from tessera.sources.tables import TEST_TABLES

SF = "/root/testdata/sf0.001"
TRAINING_DATA = re.compile(r"op\d+_|pipeline$")  # where present, these have tests of their own


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert {n for n in E.queries() if not TRAINING_DATA.match(n)} <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["rank", "period"]


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    rel = con.sql(E.oracle_sql()[name])
    dcols = rel.columns
    assert sorted(dcols) == cols
    drows = sorted((tuple(_norm(r[dcols.index(c)]) for c in cols) for r in rel.fetchall()), key=_key)
    assert len(srows) == len(drows)
    assert srows == drows
