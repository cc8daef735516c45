"""Every registered query against its DuckDB oracle (sf0.001), plus the entry contract."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from estatelake.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if type(v) is dt.date:
        v = dt.datetime(v.year, v.month, v.day)
    return v


def canon(rows, cols):
    out = [tuple(norm(r[c]) for c in cols) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["district", "avg_price", "avg_price_per_sqm", "listing_count"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = [r.asDict() for r in sdf.collect()]
    odf = duck.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(odf.columns) == cols
    orows = odf.astype(object).where(odf.notna(), None).to_dict("records")
    assert len(srows) == len(orows)
    assert canon(srows, cols) == canon(orows, cols)
