"""Every catalogue query against its DuckDB oracle on the smallest data set
(the driver repeats this at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from hearth.plans import catalog, oracle
from scripts.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES
SQL = {k: v for k, v in oracle.SQL.items() if k in QUERIES}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_serves_the_whole_catalogue():
    assert set(QUERIES) <= set(E.queries())
    assert set(SQL) <= set(E.oracle_sql())


def test_every_query_has_oracle_or_is_rows_only():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(s_rows) >= 1
        return
    cur = con.execute(SQL[name])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(s_cols, s_rows)[0] == digest(o_cols, o_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["CountyName", "AverageSalePrice"]
    assert df.count() > 0


ZONE_SENSITIVE = ["silver_sales_clean", "incremental_window", "run_summary", "cube_flatten",
                  "kpi_operations", "run_log_transitions"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    """Zone-free timestamps (run stamps, watermarks, durations) must give the
    oracle's values under a session zone with daylight saving time too."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = QUERIES[name](spark, SF)
        s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    cur = con.execute(SQL[name])
    o_cols = [d[0] for d in cur.description]
    assert digest(s_cols, s_rows)[0] == digest(o_cols, cur.fetchall())[0]
