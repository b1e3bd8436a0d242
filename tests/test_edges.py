"""Hand-written edge rows (FIXTURES.md §4, SURVEY T9) and cross-query identities."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from builders import fu, inv, item, sources
from careledger.config import DEFAULT_AS_OF as A
from careledger.operators.allocation import invoice_lines
from careledger.plans import customers as cu
from careledger.plans import followups as fq
from careledger.plans import sales

MS = A.replace(day=1)


def first(df):
    return df.collect()[0][0]


def test_zero_base_sum_gives_null_allocation(spark):
    src = sources(spark, [inv("I1", "c1", A - timedelta(days=2), 5)],
                  [item("I1", 10, "Accessories"), item("I1", -10, "Accessories")])
    vals = [r[0] for r in invoice_lines(src).select("gross_with_tax").collect()]
    assert vals == [None, None]
    assert first(sales.mtd_revenue(src, A)) is None


def test_invoice_without_items(spark):
    src = sources(spark, [inv("I1", "c1", A - timedelta(days=1), 100), inv("I2", "c1", A - timedelta(days=1), 50)],
                  [item("I1", 100, "Accessories")])
    assert first(sales.mtd_revenue(src, A)) == "₹100"
    d = sales.days_elapsed(A)
    assert first(sales.avg_daily_revenue(src, A)) == f"₹{round(150 / d)}"


def test_smart_quantity(spark):
    day = A - timedelta(days=1)
    src = sources(spark, [inv("ADDONLY", "c1", day, 10), inv("MIXED", "c2", day, 10)], [
        item("ADDONLY", 1, code="GRM-ADD-1", qty=1), item("ADDONLY", 1, code="GRM-ADD-2", qty=3),
        item("MIXED", 1, code="GRM-1", qty=1), item("MIXED", 1, code="GRM-2", qty=1),
        item("MIXED", 1, code="GRM-ADD-3", qty=5),
    ])
    assert first(sales.mtd_groomings(src, A)) == 3 + 2


def test_retention_days_45_and_90(spark):
    offsets = {"a44": 44, "d45": 45, "d46": 46, "d90": 90, "l91": 91}
    invs = [inv(f"I{c}", c, A - timedelta(days=o), 10) for c, o in offsets.items()]
    its = [item(f"I{c}", 10) for c in offsets]
    # everyone has a follow-up so they are in the work queue
    fus = [fu(f"F{c}", c, datetime(2001, 7, 1, 9), A + timedelta(days=3)) for c in offsets]
    src = sources(spark, invs, its, follow_ups=fus)
    q = fq.followup_queue(src, A, show_closed_won="Show")
    status = {r["Customer ID"]: r["Retention Status"] for r in q.collect()}
    assert status == {"a44": "Active", "d45": "Dormant (45-90 days)", "d46": "Dormant (45-90 days)",
                      "d90": "Dormant (45-90 days)", "l91": "Lost (90+ days)"}

    def count(cohort):
        return first(fq.kpi_total_in_queue(src, A, cohort=cohort, show_closed_won="Show"))

    assert count("Dormant (45-90 days)") == 3
    assert count("Lost (90+ days)") == 1
    assert count("Dormant + Lost") == 3  # day 45 is not in "Dormant + Lost" (R5)


def _overdue(src, as_of=A):
    return {r["Date"]: r["Overdue"] for r in fq.overdue_trend(src, as_of).collect()}


def test_same_day_follow_ups_first_span_empty(spark):
    d = A - timedelta(days=10)
    invs = [inv("I0", "c1", date(2001, 1, 5), 10)]
    its = [item("I0", 10, "Accessories")]
    fus = [fu("F1", "c1", datetime.combine(d, datetime.min.time()).replace(hour=10), d - timedelta(days=5)),
           fu("F2", "c1", datetime.combine(d, datetime.min.time()).replace(hour=11), d + timedelta(days=3))]
    got = _overdue(sources(spark, invs, its, follow_ups=fus))
    # F1 would be overdue from d, but F2 (same day) replaces it; F2 is overdue from d+4.
    for day, n in got.items():
        assert n == (1 if day >= d + timedelta(days=4) else 0), day


def test_won_between_two_dates(spark):
    d = A - timedelta(days=12)
    created = datetime.combine(d - timedelta(days=5), datetime.min.time()).replace(hour=9)
    invs = [inv("I0", "c1", date(2001, 1, 5), 10), inv("I1", "c1", d + timedelta(days=3), 20)]
    its = [item("I0", 10, "Accessories"), item("I1", 20)]
    fus = [fu("F1", "c1", created, d - timedelta(days=1))]
    got = _overdue(sources(spark, invs, its, follow_ups=fus))
    for day, n in got.items():
        assert n == (1 if d <= day <= d + timedelta(days=2) else 0), day


def test_first_day_of_month(spark):
    as_of = date(2001, 7, 1)
    src = sources(spark, [inv("I1", "c1", date(2001, 6, 30), 100)], [item("I1", 100)])
    assert sales.days_elapsed(as_of) == 1
    assert first(sales.mtd_revenue(src, as_of)) is None
    assert first(sales.avg_daily_revenue(src, as_of)) is None
    rows = sales.mtd_vs_projection(src, as_of).collect()
    assert len(rows) == 31 and all(r["Actual"] is None and r["Projected pace"] is None for r in rows)


def test_cohort_empty_elapsed_cell_is_zero_future_is_null(spark):
    as_of = date(2001, 7, 20)
    invs = [inv("I1", "c1", date(2001, 4, 10), 10), inv("I2", "c1", date(2001, 6, 3), 10)]
    src = sources(spark, invs, [item("I1", 10), item("I2", 10)])
    row = cu.cohort_retention(src, as_of).collect()[0].asDict()
    assert row["Cohort"] == date(2001, 4, 1)
    assert row["0"] == 100.0 and row["1"] == 0.0 and row["2"] == 100.0 and row["3"] == 0.0
    assert row["4"] is None and row["36"] is None


def test_third_pos_profile_and_blank_truck(spark):
    day = A - timedelta(days=1)
    invs = [inv("S", "c1", day, 10, pos="Vennala POS"), inv("B", "c2", day, 20, pos="  "),
            inv("N", "c3", day, 30, pos=None), inv("O", "c4", day, 40, pos="Other POS")]
    src = sources(spark, invs, [item(i[0], i[5]) for i in invs])
    row = sales.channel_sales_wide(src, A).collect()[0]
    assert (row["vennala_gross_sales"], row["truck_gross_sales"], row["total_gross_sales"]) == (10.0, 50.0, 100.0)
    stacked = {r["channel"]: r["gross_sales"] for r in sales.channel_sales_stacked(src, A).collect()}
    assert stacked == {"Vennala Store": 10.0, "Truck": 90.0}  # grouping: everything else is truck (R1)


# ---- identities between queries on the sf0.001 fixture


def test_t4_revenue_per_grooming_is_ratio(fixture_tables):
    rows = sales.avg_daily_revenue_per_grooming(fixture_tables, A).collect()
    assert rows
    for r in rows:
        expected = round(float(r["Grooming Revenue"]) / r["Groomings"]) if r["Groomings"] else None
        # revenue is rounded for display; allow the rounding slack of one rupee
        assert abs(r["Avg Daily Revenue per Grooming"] - expected) <= 1


def test_t5_current_month_matches_scorecard(fixture_tables):
    card = {r["Metric"]: r for r in sales.mtd_grooming_scorecard(fixture_tables, A, numeric=True).collect()}
    monthly = {r["channel"]: r for r in sales.avg_daily_grooming_revenue(fixture_tables, A).collect()
               if r["month"] == MS}
    for ch, r in monthly.items():
        assert card["Avg Daily Grooming Revenue"][ch] == r["Avg Daily Grooming Revenue"]


def test_t6_kpis_partition_the_queue(fixture_tables):
    base = fq.follow_up_queue(fixture_tables, A, show_closed_won="Show")
    counts = {r["call_priority"]: r["count"] for r in base.groupBy("call_priority").count().collect()}
    total = first(fq.kpi_total_in_queue(fixture_tables, A, show_closed_won="Show"))
    parts = [fq.kpi_due_today, fq.kpi_past_due, fq.kpi_never_called, fq.kpi_future_calls, fq.kpi_missing_date]
    s = sum(first(k(fixture_tables, A, show_closed_won="Show")) for k in parts)
    assert s + counts.get("Do Not Call", 0) + counts.get("Closed Won", 0) == total
