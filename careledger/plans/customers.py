"""Customer growth and retention (Q17-Q22).

All work on *paid* invoices (submitted, grand total > 0) of the chosen
channel. Per-customer facts come from one ``groupBy(customer)`` (partial
aggregation, so a customer holding a large share of invoices is combined
map-side); frames at (customer, month) grain hold at most one row per month
per customer, so joining them on customer never multiplies rows.
"""

from __future__ import annotations

import os
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as cfg
from ..functions.exprs import pct
from ..functions.params import add_months, channel_pred, month_start, relative_range, where
from ..operators.position import in_order
from ..operators.shaping import pivot_fixed
from ..session import checkpoint_dir
from ..sources.tables import at_day, customers, invoices, Sources


def paid_invoices(src: Sources, channel: str = "Both") -> DataFrame:
    """C14 + P1: submitted, positive grand total, channel filter."""
    return where(invoices(src).filter(F.col("base_grand_total") > 0), channel_pred(channel))


def complete_days(as_of: date, day: str = "posting_date") -> Column:
    """Past months whole, the current month through yesterday."""
    return (F.trunc(F.col(day), "MM") < F.lit(month_start(as_of))) | (F.col(day) < F.lit(as_of))


def month_index(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c)


def first_visit(src: Sources, channel: str = "Both") -> DataFrame:
    """V3: first paid invoice date and cohort month per customer."""
    return (
        paid_invoices(src, channel).groupBy("customer").agg(F.min("posting_date").alias("first_visit"))
        .withColumn("cohort_month", F.trunc("first_visit", "MM"))
    )


@at_day
def monthly_new_customers(src: Sources, as_of: date, channel: str = "Both",
                          date_filter: str | None = "past12months~") -> DataFrame:
    """Q17: new customers per month and the all-time running total; the date
    filter applies after the running total."""
    fv = first_visit(src, channel).filter(complete_days(as_of, "first_visit"))
    monthly = fv.groupBy(F.col("cohort_month").alias("Month")).agg(F.count(F.lit(1)).alias("New Customers"))
    # One row per month reaches the ordered window.
    w = Window.orderBy("Month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = monthly.select("Month", "New Customers", F.sum("New Customers").over(w).alias("Cumulative Customers"))
    rng = relative_range(date_filter, as_of)
    if rng is not None:
        out = out.filter(F.col("Month").between(F.lit(rng[0]), F.lit(rng[1])))
    return out.orderBy("Month")


@at_day
def returning_customers_mtd(src: Sources, as_of: date, channel: str = "Both") -> DataFrame:
    """Q18: customers first seen before this month who bought this month."""
    ms = month_start(as_of)
    in_mtd = (F.col("posting_date") >= F.lit(ms)) & (F.col("posting_date") < F.lit(as_of))
    per_customer = paid_invoices(src, channel).groupBy("customer").agg(
        F.min("posting_date").alias("first_visit"), F.max(in_mtd.cast("int")).alias("bought_mtd"))
    return per_customer.agg(
        F.count(F.when((F.col("first_visit") < F.lit(ms)) & (F.col("bought_mtd") == 1), F.lit(1))).alias("Count"))


@at_day
def customer_month_facts(src: Sources, as_of: date, channel: str = "Both") -> DataFrame:
    """Paid invoices per (customer, month): all invoices, invoices on complete
    days (C15) and the first day. One partial aggregation over the invoices;
    at most one row per month per customer."""
    return paid_invoices(src, channel).groupBy("customer", F.trunc("posting_date", "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n_invoices"),
        F.count(F.when(complete_days(as_of), F.lit(1))).alias("n_complete"),
        F.min("posting_date").alias("first_day"),
    )


@at_day
def monthly_retention_trend(src: Sources, as_of: date, channel: str = "Both") -> DataFrame:
    """Q19: per month total, returning, new and multi-visit customers with shares.

    One scan: the first visit is a window over a customer's own months, and the
    month of the first visit is where the customer is new.
    """
    own = Window.partitionBy("customer")
    facts = customer_month_facts(src, as_of, channel).withColumn("first_visit", F.min("first_day").over(own))
    active, first = F.col("n_complete") > 0, F.col("first_day") == F.col("first_visit")

    def share(condition):
        return F.count(F.when(condition, F.lit(1)))

    by_month = facts.filter(active | first).groupBy("month").agg(
        share(active).alias("t"), share(active & (F.col("first_visit") < F.col("month"))).alias("r"),
        share(active & (F.col("n_complete") >= 2)).alias("m"), share(first & complete_days(as_of, "first_visit")).alias("n"))
    t, r, n, m = (F.col(x) for x in "trnm")
    return by_month.select(
        F.col("month").alias("Month"), t.alias("Total Customers"), r.alias("Returning Customers"), n.alias("New Customers"),
        m.alias("Multi-visit Customers"), pct(r, t).alias("Returning %"), pct(n, t).alias("New %"), pct(m, t).alias("Multi-visit %")
    ).orderBy("Month")


@at_day
def cohort_retention(src: Sources, as_of: date, channel: str = "Both",
                     max_months: int = cfg.MAX_COHORT_MONTHS) -> DataFrame:
    """Q20: cohort × months-since matrix of retention %. Elapsed cells without
    customers are 0.0, cells in the future are NULL, offsets > max_months drop."""
    own = Window.partitionBy("customer")
    facts = customer_month_facts(src, as_of, channel).withColumn("first_visit", F.min("first_day").over(own))
    # A customer's first row is its cohort's offset 0, so one aggregate holds sizes and retained customers.
    cells = facts.withColumn("cohort_month", F.trunc("first_visit", "MM")).groupBy(
        "cohort_month", (month_index(F.col("month")) - month_index(F.col("cohort_month"))).alias("months_since")
    ).agg(F.count(F.when(F.col("n_complete") > 0, F.lit(1))).alias("retained"),
          F.count(F.when(F.col("first_day") == F.col("first_visit"), F.lit(1))).alias("size"))
    cohorts = cells.groupBy("cohort_month").agg(
        F.sum("size").alias("cohort_size"), F.map_from_entries(F.collect_list(F.struct("months_since", "retained"))).alias("by_offset"))
    elapsed = month_index(F.lit(month_start(as_of))) - month_index(F.col("cohort_month"))
    # One row per cohort (a month) and elapsed offset 0..min(elapsed, 36):
    # bounded by the calendar, not the data.
    grid = cohorts.filter(elapsed >= 0).select(
        "cohort_month", "cohort_size", "by_offset",
        F.explode(F.sequence(F.lit(0), F.least(elapsed, F.lit(max_months)))).alias("months_since"))
    retained = F.coalesce(F.element_at("by_offset", F.col("months_since")), F.lit(0))
    cells = grid.select("cohort_month", "months_since", F.round(
        F.lit(100.0) * retained.cast("double") / F.col("cohort_size").cast("double"), 1).alias("pct"))
    wide = pivot_fixed(cells, ["cohort_month"], "months_since", list(range(max_months + 1)), F.col("pct"))
    return wide.withColumnRenamed("cohort_month", "Cohort").orderBy("Cohort")


def _with_names(per_customer: DataFrame, src: Sources) -> DataFrame:
    """Inner join to the customer dimension (one row per customer on both sides)."""
    return per_customer.join(customers(src), per_customer.customer == F.col("name")).drop("name")


@at_day
def cohort_cell_customers(src: Sources, as_of: date, channel: str = "Both", cohort_month: date | None = None,
                          months_since: int | None = None, position: bool = False) -> DataFrame:
    """Q21: customers of one cohort cell with their invoices in that month, by revenue, name and id (``position`` adds the place).
    Empty unless both the cohort and the offset are given (P15).

    One aggregation per customer over paid invoices gives the first visit and
    the figures of the target month (cohort month + offset), so no customer's
    invoices are shuffled by customer before being combined map-side. Invoice
    ids are the primary key, so the invoice count is a row count.
    """
    if cohort_month is None or months_since is None:
        target, cohort = date(1900, 1, 1), date(1900, 1, 1)
        empty = True
    else:
        cohort = month_start(cohort_month)
        target, empty = add_months(cohort, int(months_since)), False
    in_cell = F.trunc("posting_date", "MM") == F.lit(target)
    g = F.col("base_grand_total")
    per_customer = paid_invoices(src, channel).groupBy("customer").agg(
        F.min("posting_date").alias("first_visit"),
        F.count(F.when(in_cell, F.lit(1))).alias("Invoices"),
        F.sum(F.when(in_cell, g)).alias("revenue"),
        F.min(F.when(in_cell, F.col("posting_date"))).alias("First Invoice This Period"),
        F.max(F.when(in_cell, F.col("posting_date"))).alias("Last Invoice This Period"),
    ).filter((F.trunc("first_visit", "MM") == F.lit(cohort)) & (F.col("Invoices") > 0))
    if empty:
        per_customer = per_customer.filter(F.lit(False))
    return in_order(_cell_rows(per_customer, src), [F.desc("Revenue"), F.asc("Customer"), F.asc("Customer ID")], position)


def _cell_rows(per_customer: DataFrame, src: Sources) -> DataFrame:
    return _with_names(per_customer, src).select(
        F.col("customer").alias("Customer ID"), F.coalesce(F.col("customer_name"), F.col("customer")).alias("Customer"),
        F.col("first_visit").alias("First Visit"), "Invoices", F.round(F.col("revenue"), 0).cast("double").alias("Revenue"),
        "First Invoice This Period", "Last Invoice This Period")


def _roster_rows(per_customer: DataFrame, src: Sources) -> DataFrame:
    return _with_names(per_customer, src).select(
        F.col("customer").alias("Customer ID"), F.coalesce(F.col("customer_name"), F.col("customer")).alias("Customer"),
        F.col("first_visit").alias("First Visit"), "Lifetime Invoices",
        F.round(F.col("revenue"), 0).cast("double").alias("Lifetime Revenue"), "Last Visit")


@at_day
def cohort_roster(src: Sources, as_of: date, cohort_month: date | None = None, channel: str = "Both", position: bool = False) -> DataFrame:
    """Q22: lifetime stats of every customer of one cohort (none without a cohort), from one aggregation per customer over
    paid invoices, by revenue, name and id (``position`` adds the place)."""
    wanted = F.lit(False) if cohort_month is None else F.trunc("first_visit", "MM") == F.lit(month_start(cohort_month))
    per_customer = paid_invoices(src, channel).groupBy("customer").agg(
        F.min("posting_date").alias("first_visit"),
        F.count(F.lit(1)).alias("Lifetime Invoices"),
        F.sum("base_grand_total").alias("revenue"),
        F.max("posting_date").alias("Last Visit"),
    ).filter(wanted)
    return in_order(_roster_rows(per_customer, src), [F.desc("Lifetime Revenue"), F.asc("Customer"), F.asc("Customer ID")], position)


# ------------------------------------------------------------ drill-through


@at_day
def write_cohort_cells(src: Sources, as_of: date, root: str, channel: str = "Both") -> str:
    """Store what the cells of the cohort matrix (Q20) open: a row per customer and month, in a folder for each cohort.

    One aggregation by customer and month; the first month is a window over a customer's own months. A cohort's rows are
    dealt by month as well, so a large cohort is written by several tasks."""
    own = Window.partitionBy("customer")
    rows = paid_invoices(src, channel).groupBy("customer", F.trunc("posting_date", "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("invoices"), F.sum("base_grand_total").alias("revenue"),
        F.min("posting_date").alias("first_day"), F.max("posting_date").alias("last_day"))
    rows = rows.withColumn("first_visit", F.min("first_day").over(own)).withColumn("cohort", F.trunc("first_visit", "MM"))
    rows = rows.withColumn("months_since", month_index(F.col("month")) - month_index(F.col("cohort"))).drop("month")
    rows.repartitionByRange("cohort", "months_since", "customer").write.mode("overwrite").partitionBy("cohort").parquet(root)
    return root


def cohort_drill(src: Sources, root: str, cohort: date, months_since: int | None = None, position: bool = False) -> DataFrame:
    """Open the stored cells of one cohort, reading its folder only. A cell (cohort row, month column) opens its
    customers (Q21), the cohort label the roster of the whole cohort (Q22)."""
    cells = src.sales_invoice.sparkSession.read.parquet(root).filter(F.col("cohort") == F.lit(month_start(cohort)))
    if months_since is not None:
        cell = cells.filter(F.col("months_since") == months_since).select(
            "customer", "first_visit", F.col("invoices").alias("Invoices"), "revenue",
            F.col("first_day").alias("First Invoice This Period"), F.col("last_day").alias("Last Invoice This Period"))
        return in_order(_cell_rows(cell, src), [F.desc("Revenue"), F.asc("Customer"), F.asc("Customer ID")], position)
    roster = cells.groupBy("customer", "first_visit").agg(
        F.sum("invoices").alias("Lifetime Invoices"), F.sum("revenue").alias("revenue"), F.max("last_day").alias("Last Visit"))
    return in_order(_roster_rows(roster, src), [F.desc("Lifetime Revenue"), F.asc("Customer"), F.asc("Customer ID")], position)


def stored_drill(src: Sources, as_of: date, cohort: date, months_since: int | None = None, channel: str = "Both") -> DataFrame:
    """Write the cells of a day into the shared folder and open one from there."""
    root = os.path.join(checkpoint_dir(src.sales_invoice.sparkSession), f"cohort_cells_{uuid.uuid4().hex}")
    return cohort_drill(src, write_cohort_cells(src, as_of, root, channel), cohort, months_since)
