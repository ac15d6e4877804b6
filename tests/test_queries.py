"""Every query with SQL beside it against DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from strandforge.plans import catalogue


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(round(r[i], 9) if isinstance(r[i], float) else r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, sf, name):
    df = catalogue.queries()[name](spark, sf)
    want = con.sql(catalogue.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(want.fetchall(), want.columns)


def test_chain_derives_records_once(spark, sf):
    """No condition of a filter holds the expressions that sequences are derived by."""
    plan = catalogue.queries()["post_filter_chain"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in plan
