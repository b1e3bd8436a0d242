"""What plans read: months of both facts, the work queue before the items, each table once; and places as data."""

from __future__ import annotations

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from builders import fu, inv, item, sources
from careledger.config import DEFAULT_AS_OF as A
from careledger.operators.position import with_position
from careledger.operators.summary import invoice_totals
from careledger.plans import customers as cu
from careledger.plans import followups as fq
from careledger.plans import registry, sales
from careledger.sources.tables import GROOMED, MONTH, read_tables, write_tables


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


#: A column that every scan of the table asks for (paths are cut in plans).
READS = {"sales_invoice": "docstatus", "sales_invoice_item": "parent", "customer_follow_up": "creation"}


def scans(df, table: str) -> list[str]:
    return [s for s in re.findall(r"FileScan parquet.*", plan_of(df)) if re.search(rf"ReadSchema: struct<.*\b{READS[table]}:", s)]


@pytest.mark.parametrize("name", ["q05_past7_daily_sales", "q06_past7_daily_sales_detail", "q07_mtd_revenue", "q08_mtd_groomings",
                                  "q10_mtd_revenue_by_channel_category", "q11_mtd_grooming_scorecard", "q16_rolling_30d"])
def test_both_facts_are_pruned_by_month(fixture_tables, name):
    df = registry.run(registry.by_name()[name], fixture_tables)
    for table in ("sales_invoice", "sales_invoice_item"):
        (scan,) = scans(df, table)
        assert re.search(r"PartitionFilters: \[[^\]]*posting_month[^\]]*>=", scan), (table, scan)


def test_items_follow_their_invoices_month(fixture_tables):
    lost = fixture_tables.sales_invoice_item.join(
        fixture_tables.sales_invoice.select(F.col("name").alias("parent"), F.trunc("posting_date", "MM").alias("own")), "parent").filter(F.col(MONTH) != F.col("own"))
    assert lost.count() == 0


def test_items_without_an_invoice_are_kept(spark, tmp_path):
    src = sources(spark, [inv("I1", "c1", date(2001, 7, 1), 10)], [item("I1", 10), item("GONE", 5)])
    write_tables(src, str(tmp_path))
    back = read_tables(spark, str(tmp_path))
    assert sorted((r["parent"], str(r[MONTH])) for r in back.sales_invoice_item.collect()) == [("GONE", "None"), ("I1", "2001-07-01")]
    assert back.sales_invoice.first()[GROOMED] is True


@pytest.mark.parametrize("name", ["q34_overdue_trend", "q34_overdue_trend_truck_lost", "q16_rolling_30d", "q23_customer_profile_v1"])
def test_each_table_is_read_once(fixture_tables, name):
    df = registry.run(registry.by_name()[name], fixture_tables)
    for table, most in (("sales_invoice", 1), ("sales_invoice_item", 1), ("customer_follow_up", 1)):
        assert len(scans(df, table)) <= most, table
    assert scans(df, "sales_invoice")


def test_cold_customers_reach_no_aggregate(spark, tmp_path):
    """Q24 over a customer of the queue and one outside it, whose lines are dropped before they are totalled."""
    old, new = date(2001, 1, 5), A
    src = sources(spark, [inv("H1", "hot", new, 10), inv("C1", "cold", new, 20), inv("O1", "old", old, 30)],
                  [item("H1", 10), item("C1", 20), item("O1", 30)], follow_ups=[fu("F1", "hot", datetime(2001, 7, 1), A)])
    write_tables(src, str(tmp_path))
    for s in (src, read_tables(spark, str(tmp_path))):
        queue = fq.work_queue(s.at(A), A)
        assert sorted(r[0] for r in queue.collect()) == ["hot", "old"]
        assert sorted(r["name"] for r in invoice_totals(s, only=queue, without_lines=True).collect()) == ["H1", "O1"]
        assert sorted(r["Customer ID"] for r in fq.followup_queue(s, A, show_closed_won="Show").collect()) == ["hot", "old"]
    df = fq.followup_queue(read_tables(spark, str(tmp_path)), A)
    plan = plan_of(df)
    assert "LeftSemi" in plan and len(scans(df, "sales_invoice_item")) == 1
    semi, totals = (min(n for n, line in enumerate(plan.splitlines()) if mark in line) for mark in ("LeftSemi", "partial_sum(base_amount"))
    assert totals < semi  # printed from the top: the restriction lies below the totals


def test_positions_cross_partitions(spark):
    df = spark.range(0, 5000, 1, 7).selectExpr("(id * 7919) % 5000 AS x", "id AS y")
    got = with_position(df, [F.desc("x")]).collect()
    assert len(got) == 5000 and all(r["Position"] == 5000 - r["x"] for r in got)
    assert with_position(df.filter("x < 0"), [F.asc("x")]).count() == 0


def test_equal_rank_and_urgency_go_by_customer(spark):
    src = sources(spark, [inv(f"I{c}", c, date(2001, 1, 5), 10) for c in "dbca"], [item(f"I{c}", 10) for c in "dbca"])
    assert [r["Customer ID"] for r in fq.followup_queue(src, A).collect()] == list("abcd")


def test_a_cell_opens_one_folder(fixture_tables, tmp_path):
    root = cu.write_cohort_cells(fixture_tables, A, str(tmp_path / "cells"))
    df = cu.cohort_drill(fixture_tables, root, date(1995, 1, 1), 6)
    scan = next(s for s in re.findall(r"FileScan parquet.*", plan_of(df)) if "cells" in s)
    assert re.search(r"PartitionFilters: \[[^\]]*cohort[^\]]*= 1995-01-01", scan)
    want = cu.cohort_cell_customers(fixture_tables, A, cohort_month=date(1995, 1, 1), months_since=6)
    assert list(map(tuple, df.collect())) == list(map(tuple, want.collect()))
    roster = cu.cohort_drill(fixture_tables, root, date(1995, 2, 1))
    assert list(map(tuple, roster.collect())) == list(map(tuple, cu.cohort_roster(fixture_tables, A, cohort_month=date(1995, 2, 1)).collect()))


def test_wider_spines_on_demand(fixture_tables):
    assert sales.daily_sales_by_channel(fixture_tables, A, None).count() == 2 * 401
    assert sales.daily_sales_by_channel(fixture_tables, A, None, days=800).count() == 2 * 800
    assert sales.rolling_30d(fixture_tables, A, date_filter=None, months=24).count() == 732


def test_large_amounts_keep_their_share(spark):
    src = sources(spark, [inv("I1", "c1", date(2001, 7, 2), "300000000000000", "300000000000000")],
                  [item("I1", "60000000000000"), item("I1", "40000000000000", "Accessories")], follow_ups=[fu("F1", "c1", datetime(2001, 7, 1), A)])
    assert fq.followup_queue(src, A, show_closed_won="Show").first()["Grooming Revenue"] == 180000000000000.0
    assert sales.mtd_revenue(src, A).first()[0].endswith("00,00,000")
