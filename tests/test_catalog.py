"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import math
import os
from pathlib import Path

import pytest

from tillwatch.catalog import queries
from tillwatch.catalog_sql import oracle_sql

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents".split()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def cells(frame, columns):
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        return repr(float(v)) if isinstance(v, float) else str(v)

    return sorted(tuple(cell(v) for v in row) for row in frame[columns].itertuples(index=False))


def test_entry_gives_rows(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_sql(spark, duck, name):
    got, want = queries()[name](spark, SF).toPandas(), duck.execute(oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert cells(got, columns) == cells(want, columns)
