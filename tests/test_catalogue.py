"""Every query of the track operators against its SQL on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from tracklens.plans import catalogue

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def rows(df):
    columns = sorted(df.columns)
    values = df[columns].astype(object).where(df[columns].notna(), None)
    return columns, sorted(map(tuple, values.values.tolist()), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_matches_sql(spark, duck, name):
    got = rows(catalogue.QUERIES[name](spark, DATA).toPandas())
    want = rows(duck.execute(catalogue.ORACLES[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    for a, b in zip(got[1], want[1], strict=True):
        assert a == pytest.approx(b, abs=2e-6)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, DATA).count() > 0
