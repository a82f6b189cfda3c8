"""Every registered query runs at sf0.001; those with SQL match DuckDB."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402
from conftest import SF_SMALL  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query(spark, con, name):
    pdf = E.queries()[name](spark, SF_SMALL).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:  # what SQL cannot express is held against brute force elsewhere
        assert len(pdf) > 0 and len(pdf.columns) > 0
        return
    opdf = con.execute(sql).fetchdf()
    sc, sr = rows_of(pdf)
    oc, orows = rows_of(opdf)
    assert sc == oc
    assert len(sr) == len(orows)
    assert sr == orows
