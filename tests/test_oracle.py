"""Every registered query equals its DuckDB oracle SQL (exact values)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from strata import catalog
from scripts.check_oracle import SPARK_TO_DUCK, TABLES, rows_of

from tests.conftest import SF_SMALL

QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle_sql():
    assert set(ORACLE) == set(QUERIES)
    assert len(KEYS) >= 54
    assert entry.queries().items() >= QUERIES.items() and entry.oracle_sql().items() >= ORACLE.items()


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    cur = con.execute(ORACLE[key])
    d_cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = {c[0]: str(c[1]) for c in cur.description}
    assert spark_types == duck_types
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(cur.fetchall(), d_cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns


@pytest.mark.parametrize("key", ["process_order_items", "curate_order_items", "scalar_try_cast",
                                 "scalar_round_money", "mart_daily_sales", "dq_order_items"])
def test_same_results_with_ansi_mode_off(spark, con, key):
    """Every parse is a try_* function, so legacy (non-ANSI) sessions agree."""
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = QUERIES[key](spark, SF_SMALL)
        rows = rows_of([tuple(r) for r in df.collect()], df.columns)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    cur = con.execute(ORACLE[key])
    assert rows == rows_of(cur.fetchall(), [c[0] for c in cur.description])
