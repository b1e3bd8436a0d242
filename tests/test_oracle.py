"""Every registered query equals its DuckDB oracle on the same parquet (sf0.001)."""

from __future__ import annotations

import pytest

from careledger.plans import registry
from oracle_check import duck_con, rows_of

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck_con(SF_SMALL)


@pytest.mark.parametrize("q", registry.QUERIES, ids=[q.name for q in registry.QUERIES])
def test_query_matches_oracle(spark, fixture_tables, con, q):
    df = registry.run(q, fixture_tables)
    s_rows = [tuple(r) for r in df.collect()]
    sql = registry.oracle_text(q)
    assert sql is not None
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_rows, df.columns) == rows_of(d_rows, d_cols)


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["Customer ID", "Customer", "Call Priority"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {q.name for q in registry.QUERIES} <= set(entry.oracle_sql())


SKEW_CHECKED = ("q16_rolling_30d", "q19_monthly_retention_trend", "q20_cohort_retention",
                "q21_cohort_cell_customers", "q22_cohort_roster", "q23_customer_profile_v1", "q24_followup_queue",
                "q32_kpi_total_in_queue", "q34_overdue_trend", "q11_mtd_grooming_scorecard")


@pytest.fixture(scope="module")
def skewed_dir():
    """sf0.001 with one customer holding a third of all orders and ten
    customers holding a third of all follow-ups and calls."""
    import tempfile

    d = tempfile.mkdtemp(prefix="careledger-skew-")
    con = duckdb_connect()
    for t in ("region", "nation", "customer", "supplier", "part", "lineitem"):
        con.execute(f"COPY (SELECT * FROM '{SF_SMALL}/{t}.parquet') TO '{d}/{t}.parquet' (FORMAT parquet)")
    con.execute(f"COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey) "
                f"FROM '{SF_SMALL}/orders.parquet') TO '{d}/orders.parquet' (FORMAT parquet)")
    con.execute(f"COPY (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) "
                f"FROM '{SF_SMALL}/events.parquet') TO '{d}/events.parquet' (FORMAT parquet)")
    return d


def duckdb_connect():
    import duckdb

    return duckdb.connect()


@pytest.mark.parametrize("name", SKEW_CHECKED)
def test_hot_customer_matches_oracle(spark, skewed_dir, name):
    q = registry.by_name()[name]
    df = registry.spark_callable(q)(spark, skewed_dir)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck_con(skewed_dir).execute(registry.oracle_text(q))
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert len(s_rows) == len(d_rows) > 0
    assert rows_of(s_rows, df.columns) == rows_of(d_rows, d_cols)
