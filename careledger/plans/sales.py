"""Sales by channel, month-to-date scorecards, grooming revenue, rolling activity
(Q01-Q16).

Every function takes the retail ``Sources``, an explicit ``as_of`` date and
typed parameters, and returns a lazy DataFrame. Money is summed as exact
decimals and rounded before it is cast to double for output.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as cfg
from ..functions.exprs import channel2, inr, inr_sql, is_blank, is_store, money, safe_div
from ..functions.params import add_months, channel_pred, last_day, month_start, relative_range
from ..operators.allocation import GROSS, allocated_part, invoice_categories
from ..operators.shaping import fill_spine, pivot_fixed
from ..operators.summary import invoice_totals
from ..sources.calendar import spine, spine_grid, spine_numbered
from ..sources.tables import at_day, invoices, Sources


def _spark(src: Sources) -> SparkSession:
    return src.sales_invoice.sparkSession


def days_elapsed(as_of: date) -> int:
    """Complete days of the month before as_of (today excluded), at least 1."""
    return max((as_of - timedelta(days=1) - month_start(as_of)).days + 1, 1)


def _mtd(as_of: date) -> tuple[date, date]:
    """First and last day of the month to date; the last is before the first on the first of a month."""
    return month_start(as_of), as_of - timedelta(days=1)


def _mtd_invoices(src: Sources, as_of: date) -> DataFrame:
    return invoices(src, *_mtd(as_of))


# ---------------------------------------------------------------- Q01-Q03
def _channel_daily(src: Sources, start_date: date | None, end_date: date | None) -> DataFrame:
    inv = invoices(src, start_date, end_date)
    return inv.withColumn("channel", channel2(store_label=cfg.STORE_LABEL_LONG))


@at_day
def channel_sales_table(src: Sources, as_of: date, start_date: date | None = None,
                        end_date: date | None = None) -> DataFrame:
    """Q01: gross, net and tax per day and channel."""
    return (
        _channel_daily(src, start_date, end_date)
        .groupBy("posting_date", "channel")
        .agg(money(F.sum("base_grand_total"), 2).alias("gross_sales"),
             money(F.sum("base_net_total"), 2).alias("net_sales"),
             money(F.sum(F.col("base_grand_total") - F.col("base_net_total")), 2).alias("tax"))
        .select(F.col("posting_date").alias("date"), "channel", "gross_sales", "net_sales", "tax")
        .orderBy(F.col("date").desc(), "channel")
    )


@at_day
def channel_sales_wide(src: Sources, as_of: date, start_date: date | None = None,
                       end_date: date | None = None) -> DataFrame:
    """Q02: store (named profile), truck (blank profile only) and total per day."""
    g = F.col("base_grand_total")
    zero = F.lit(0)
    return (
        invoices(src, start_date, end_date)
        .groupBy("posting_date")
        .agg(money(F.sum(F.when(is_store(), g).otherwise(zero)), 2).alias("vennala_gross_sales"),
             money(F.sum(F.when(is_blank("pos_profile"), g).otherwise(zero)), 2).alias("truck_gross_sales"),
             money(F.sum(g), 2).alias("total_gross_sales"))
        .select(F.col("posting_date").alias("date"), "vennala_gross_sales", "truck_gross_sales", "total_gross_sales")
        .orderBy("date")
    )


@at_day
def channel_sales_stacked(src: Sources, as_of: date, start_date: date | None = None,
                          end_date: date | None = None) -> DataFrame:
    """Q03: gross per day and channel, ascending."""
    return (
        _channel_daily(src, start_date, end_date)
        .groupBy("posting_date", "channel")
        .agg(money(F.sum("base_grand_total"), 2).alias("gross_sales"))
        .select(F.col("posting_date").alias("date"), "channel", "gross_sales")
        .orderBy("date", "channel")
    )


# ---------------------------------------------------------------- Q04
@at_day
def daily_sales_by_channel(src: Sources, as_of: date, date_filter: str | None = "past3months~", days: int = 401) -> DataFrame:
    """Q04: spine of the last ``days`` days (the chart's 401) × 2 channels, zero-filled; the date filter chooses among them."""
    start, end = as_of - timedelta(days=days - 1), as_of
    rng = relative_range(date_filter, as_of)
    if rng is not None:
        start, end = max(start, rng[0]), min(end, rng[1])
    spark = _spark(src)
    empty = end < start
    if empty:  # filter outside the spine: keep the schema, no rows
        start = end = as_of
    grid = spine_grid(spark, start, end, [(cfg.STORE_LABEL_LONG,), (cfg.TRUCK_LABEL,)], ["channel"])
    if empty:
        grid = grid.filter(F.lit(False))
    daily = (
        invoices(src, start, end)
        .withColumn("channel", channel2(store_label=cfg.STORE_LABEL_LONG))
        .groupBy(F.col("posting_date").alias("date"), "channel")
        .agg(money(F.sum("base_grand_total"), 2).alias("gross_sales"),
             money(F.sum("base_net_total"), 2).alias("net_sales"),
             money(F.sum(F.col("base_grand_total") - F.col("base_net_total")), 2).alias("tax"))
    )
    return fill_spine(grid, daily, ["date", "channel"], {"gross_sales": 0.0, "net_sales": 0.0, "tax": 0.0}) \
        .orderBy(F.col("date").desc(), "channel")


# ---------------------------------------------------------------- Q05-Q06
SEGMENTS = [(cfg.STORE_LABEL_LONG, cfg.CATEGORY_GROOMING), (cfg.STORE_LABEL_LONG, cfg.CATEGORY_PRODUCT),
            (cfg.TRUCK_LABEL, cfg.CATEGORY_GROOMING), (cfg.TRUCK_LABEL, cfg.CATEGORY_PRODUCT)]


def _past7_segment_sums(src: Sources, as_of: date) -> DataFrame:
    cats = invoice_categories(src, as_of - timedelta(days=7), as_of)
    return (
        cats.select(F.col("posting_date").alias("date"),
                    channel2(store_label=cfg.STORE_LABEL_LONG).alias("channel"),
                    F.col("category").alias("sales_type"), GROSS)
        .groupBy("date", "channel", "sales_type").agg(F.sum(GROSS).alias("gross_inr"))
    )


@at_day
def past7_daily_sales(src: Sources, as_of: date) -> DataFrame:
    """Q05: last 7 complete days × 4 segments, tax-allocated gross, zero-filled."""
    spark = _spark(src)
    grid = spine_grid(spark, as_of - timedelta(days=7), as_of - timedelta(days=1), SEGMENTS,
                      ["channel", "sales_type"])
    daily = _past7_segment_sums(src, as_of)
    filled = fill_spine(grid, daily, ["date", "channel", "sales_type"], {"gross_inr": F.lit(0)})
    return filled.select(
        "date",
        F.concat(F.col("channel"), F.lit(" · "), F.col("sales_type")).alias("segment"),
        money(F.col("gross_inr"), 0).alias("gross_sales_inr"),
        "channel", "sales_type",
    ).orderBy("date", "channel", "sales_type").drop("channel", "sales_type")


DETAIL_COLUMNS = ["Store · Grooming", "Store · Product", "Truck · Grooming", "Truck · Product"]


@at_day
def past7_daily_sales_detail(src: Sources, as_of: date) -> DataFrame:
    """Q06: the same days as a table; amounts rounded before the pivot."""
    spark = _spark(src)
    days = spine(spark, as_of - timedelta(days=7), as_of - timedelta(days=1))
    seg = _past7_segment_sums(src, as_of).select(
        "date", F.concat(F.col("channel"), F.lit("|"), F.col("sales_type")).alias("seg"),
        F.round(F.col("gross_inr"), 0).alias("amount"))
    wide = pivot_fixed(seg, ["date"], "seg", [f"{c}|{t}" for c, t in SEGMENTS], F.col("amount"),
                       names=DETAIL_COLUMNS)
    filled = fill_spine(days, wide, ["date"], {c: F.lit(0) for c in DETAIL_COLUMNS})
    total = sum((F.col(c) for c in DETAIL_COLUMNS[1:]), F.col(DETAIL_COLUMNS[0]))
    return filled.select(
        F.date_format("date", "dd MMM").alias("Date"),
        total.cast("double").alias("Total"),
        *(F.col(c).cast("double").alias(c) for c in DETAIL_COLUMNS),
        F.col("date").alias("_day"),
    ).orderBy("_day").drop("_day")


# ---------------------------------------------------------------- Q07-Q11
@at_day
def mtd_revenue(src: Sources, as_of: date) -> DataFrame:
    """Q07: Σ tax-allocated lines month to date (today excluded), ₹-formatted."""
    cats = invoice_categories(src, month_start(as_of), as_of, invoice_cols=())
    return cats.agg(F.sum(GROSS).alias("total")).select(inr("total").alias("Value"))


@at_day
def mtd_groomings(src: Sources, as_of: date) -> DataFrame:
    """Q08: Σ smart grooming quantity month to date."""
    smart = F.col("smart_qty")
    return invoice_totals(src, *_mtd(as_of)).agg(
        F.round(F.coalesce(F.sum(F.when(smart > 0, smart)), F.lit(0)), 0).cast("bigint").alias("Count"))


@at_day
def avg_daily_revenue(src: Sources, as_of: date) -> DataFrame:
    """Q09: Σ grand total month to date / complete days, ₹."""
    d = days_elapsed(as_of)
    return _mtd_invoices(src, as_of).agg(
        (F.sum("base_grand_total").cast("double") / F.lit(float(d))).alias("avg")).select(inr("avg").alias("Value"))


CATEGORY_ORDER = [cfg.CATEGORY_GROOMING, cfg.CATEGORY_PRODUCT, "Total"]


@at_day
def mtd_revenue_by_channel_category(src: Sources, as_of: date, position: bool = False) -> DataFrame:
    """Q10: category × Store/Truck/Total, plus a total row over the rounded cells; ``position`` adds the row's place."""
    cats = invoice_categories(src, month_start(as_of), as_of)
    g = F.col(GROSS)
    store = channel2() == cfg.STORE_LABEL
    per_cat = (
        cats.groupBy(F.col("category").alias("Category"))
        .agg(F.round(F.sum(F.when(store, g).otherwise(F.lit(0))), 0).alias("store_amt"),
             F.round(F.sum(F.when(~store, g).otherwise(F.lit(0))), 0).alias("truck_amt"),
             F.round(F.sum(g), 0).alias("total_amt"))
    )
    # Total row = sums of the already rounded cells (a rollup over ≤ 2 rows).
    rows = per_cat.rollup("Category").agg(*[F.sum(c).alias(c) for c in ("store_amt", "truck_amt", "total_amt")]) \
        .withColumn("Category", F.coalesce(F.col("Category"), F.lit("Total")))
    rows = rows.select(
        "Category", inr("store_amt").alias("Store"), inr("truck_amt").alias("Truck"),
        inr("total_amt").alias("Total"),
        F.array_position(F.array(*[F.lit(c) for c in CATEGORY_ORDER]), F.col("Category")).alias("Position"),
    ).orderBy("Position")
    return rows if position else rows.drop("Position")


@at_day
def mtd_grooming_scorecard(src: Sources, as_of: date, numeric: bool = False) -> DataFrame:
    """Q11: five grooming metrics × Store/Truck/Total for the month to date.

    Counts print as integers, average counts with one decimal, money as ₹
    (X5). ``numeric=True`` returns the unformatted doubles instead.
    """
    d = float(days_elapsed(as_of))
    # One row per invoice gives the sales, the smart grooming quantity and the
    # grooming revenue; then per channel (≤ 2 rows).
    per_invoice = invoice_totals(src, *_mtd(as_of), without_lines=True).select(
        channel2().alias("channel"), F.col("smart_qty").alias("sq"), "base_grand_total",
        F.when(F.col("grooming_lines") > 0, allocated_part("grooming_base")).alias("groom_rev"))
    per_channel = per_invoice.groupBy("channel").agg(
        F.sum(F.when(F.col("sq") > 0, F.col("sq"))).alias("g"),
        F.sum("groom_rev").alias("r"),
        F.sum("base_grand_total").alias("mtd_sales"),
    )

    def cell(expr, channel):
        return F.coalesce(F.max(F.when(F.col("channel") == channel, expr)), F.lit(0))

    def wide(expr, prefix, present=None):
        e = expr if present is None else F.when(present, expr)
        return [cell(e, cfg.STORE_LABEL).alias(f"{prefix}_s"), cell(e, cfg.TRUCK_LABEL).alias(f"{prefix}_t"),
                F.coalesce(F.sum(e), F.lit(0)).alias(f"{prefix}_a")]

    # Revenue per grooming only counts channels that have groomings (the
    # reference joins revenue onto the grooming rows).
    has_g = F.col("g").isNotNull()
    one = per_channel.agg(
        *wide(F.col("g"), "g"), *wide(F.col("r"), "r"),
        *wide(F.coalesce(F.col("r"), F.lit(0)), "cr", has_g), *wide(F.col("g"), "cg", has_g),
        *wide(F.col("mtd_sales"), "s"))

    def dbl(name):
        return F.col(name).cast("double")

    metrics = [
        ("MTD Groomings", "count0", [F.round(dbl(f"g_{x}"), 0) for x in "sta"]),
        ("Avg Daily Groomings", "count1", [F.round(dbl(f"g_{x}") / F.lit(d), 1) for x in "sta"]),
        ("Avg Daily Grooming Revenue", "rupee", [F.round(dbl(f"r_{x}") / F.lit(d), 0) for x in "sta"]),
        ("MTD Avg Revenue per Grooming", "rupee",
         [F.round(safe_div(F.col(f"cr_{x}"), F.col(f"g_{x}")), 0) for x in "sta"]),
        ("Avg Daily Revenue (incl. tax)", "rupee", [F.round(dbl(f"s_{x}") / F.lit(d), 0) for x in "sta"]),
    ]
    # One numeric row per metric from the single-row frame, then C18: the
    # value kind picks the format, in one SQL expression per cell.
    rows = [F.struct(F.lit(i).alias("_ord"), F.lit(name).alias("Metric"), F.lit(kind).alias("kind"),
                     *(v.alias(c) for v, c in zip(vals, ["Store", "Truck", "Total"])))
            for i, (name, kind, vals) in enumerate(metrics)]
    numeric_rows = one.select(F.explode(F.array(*rows)).alias("m")).select("m.*")
    if numeric:
        return numeric_rows.orderBy("_ord").select("Metric", "Store", "Truck", "Total")

    def formatted(c):
        return F.expr(f"CASE kind WHEN 'rupee' THEN {inr_sql(c)} "
                      f"WHEN 'count0' THEN CAST(CAST({c} AS DECIMAL(20,0)) AS STRING) "
                      f"ELSE CAST(CAST({c} AS DECIMAL(20,1)) AS STRING) END").alias(c)

    return numeric_rows.orderBy("_ord").select("Metric", *(formatted(c) for c in ["Store", "Truck", "Total"]))


# ---------------------------------------------------------------- Q12-Q13
def _mtd_avg_daily(src: Sources, as_of: date) -> DataFrame:
    """One row, avg_daily = Σ grand total MTD / days elapsed (NULL if none)."""
    d = float(days_elapsed(as_of))
    return _mtd_invoices(src, as_of).agg(
        (F.sum("base_grand_total").cast("double") / F.lit(d)).alias("avg_daily"))


@at_day
def mtd_vs_projection(src: Sources, as_of: date) -> DataFrame:
    """Q12: running actual (lakh, NULL from today on) vs projected pace."""
    spark = _spark(src)
    ms = month_start(as_of)
    d = float(days_elapsed(as_of))
    days = spine_numbered(spark, ms, last_day(as_of), "date", "day_num")
    daily = _mtd_invoices(src, as_of).groupBy(F.col("posting_date").alias("date")) \
        .agg(F.sum("base_grand_total").alias("daily_gross"))
    # ≤ 31 spine rows: the running sum and the month's average (V19) are
    # unpartitioned windows over the spine only.
    running = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    avg_daily = F.sum("daily_gross").over(whole).cast("double") / F.lit(d)
    return (
        daily.join(F.broadcast(days), "date", "right")
        .select("date",
                F.when(F.col("date") < F.lit(as_of),
                       F.round(F.sum(F.coalesce(F.col("daily_gross"), F.lit(0))).over(running).cast("double")
                               / F.lit(100000.0), 2)).alias("Actual"),
                F.round(avg_daily * F.col("day_num") / F.lit(100000.0), 2).alias("Projected pace"))
        .orderBy("date")
    )


@at_day
def projected_month_end_sales(src: Sources, as_of: date) -> DataFrame:
    """Q13: average daily sales × days in the month, ₹."""
    dim = float(last_day(as_of).day)
    return _mtd_avg_daily(src, as_of).select((F.col("avg_daily") * F.lit(dim)).alias("projected")) \
        .select(inr("projected").alias("Value"))


# ---------------------------------------------------------------- Q14-Q15
def _days_counted(month: str, as_of: date):
    end = F.least(F.last_day(F.col(month)), F.lit(as_of - timedelta(days=1)))
    return (F.datediff(end, F.col(month)) + 1).cast("int")


def _monthly_grooming_invoices(src: Sources, as_of: date) -> DataFrame:
    """Invoices before as_of with grooming lines: month, channel, allocated
    grooming revenue (allocation over the whole invoice) and smart quantity."""
    return invoice_totals(src, None, as_of - timedelta(days=1)).filter(F.col("grooming_lines") > 0).select(
        F.trunc("posting_date", "MM").alias("month"), channel2().alias("channel"),
        allocated_part("grooming_base").alias("rev"), "smart_qty")


def _monthly_grooming_revenue(per_invoice: DataFrame) -> DataFrame:
    return per_invoice.groupBy("month", "channel").agg(F.sum("rev").alias("grooming_revenue")) \
        .filter(F.col("grooming_revenue") > 0)


@at_day
def avg_daily_grooming_revenue(src: Sources, as_of: date) -> DataFrame:
    """Q14: grooming revenue per month and channel / days counted."""
    rev = _monthly_grooming_revenue(_monthly_grooming_invoices(src, as_of))
    days = _days_counted("month", as_of)
    return rev.select(
        "month", "channel", money(F.col("grooming_revenue"), 0).alias("Grooming Revenue"),
        days.alias("Days Counted"),
        F.round(F.col("grooming_revenue").cast("double") / days, 0).alias("Avg Daily Grooming Revenue"),
    ).orderBy("month", "channel")


@at_day
def avg_daily_revenue_per_grooming(src: Sources, as_of: date) -> DataFrame:
    """Q15: monthly grooming revenue and groomings, both per day, divided.

    One aggregation per invoice gives both the grooming revenue and the smart
    quantity; one more per (month, channel) gives both monthly figures."""
    per_invoice = _monthly_grooming_invoices(src, as_of)
    monthly = per_invoice.groupBy("month", "channel").agg(
        F.sum("rev").alias("grooming_revenue"),
        F.sum(F.when(F.col("smart_qty") > 0, F.col("smart_qty"))).alias("groomings"),
    ).filter((F.col("grooming_revenue") > 0) & F.col("groomings").isNotNull())
    days = _days_counted("month", as_of).cast("double")
    per_day_rev = F.col("grooming_revenue").cast("double") / days
    per_day_groom = F.col("groomings").cast("double") / days
    return monthly.select(
        "month", "channel", money(F.col("grooming_revenue"), 0).alias("Grooming Revenue"),
        F.col("groomings").cast("double").alias("Groomings"),
        _days_counted("month", as_of).alias("Days Counted"),
        F.round(per_day_rev / F.nullif(per_day_groom, F.lit(0.0)), 0).alias("Avg Daily Revenue per Grooming"),
    ).orderBy("month", "channel")


# ---------------------------------------------------------------- Q16
def customer_days(src: Sources, lo: date, hi: date, channel: str = "Both") -> DataFrame:
    """One row per customer and day with an invoice in lo..hi: the smart grooming quantity of that day."""
    smart = F.col("smart_qty")
    totals = invoice_totals(src, lo, hi, channel_pred(channel), without_lines=True)
    return totals.groupBy("customer", "posting_date").agg(F.sum(F.when(smart > 0, smart)).alias("groomings"))


def day_changes(days: DataFrame, width: int) -> DataFrame:
    """What the visits of each day (``on``) change in the daily counts of active customers and groomings.

    A visit makes its customer active for ``width`` days. One that comes while an earlier one lasts ends that on its own
    day; ``prev`` is the earlier visit's day on those two rows, so they can be left out with it. The window sees one row
    for each day of a customer, and a day has at most 2 * ``width`` rows here.
    """
    lasting = f"datediff(posting_date, prev) < {width}"
    days = days.withColumn("prev", F.expr("lag(posting_date) OVER (PARTITION BY customer ORDER BY posting_date)"))
    rows = days.selectExpr("posting_date AS on", f"""inline(array(
        struct(posting_date AS day, 1 AS step, CAST(NULL AS DATE) AS prev, groomings AS groomings),
        struct(date_add(posting_date, {width}) AS day, -1 AS step, CAST(NULL AS DATE) AS prev, NULL AS groomings),
        struct(CASE WHEN {lasting} THEN posting_date END AS day, -1 AS step, prev AS prev, NULL AS groomings),
        struct(CASE WHEN {lasting} THEN date_add(prev, {width}) END AS day, 1 AS step, prev AS prev, NULL AS groomings)))""")
    return rows.filter("day IS NOT NULL").groupBy("on", "day", "prev").agg(F.sum("step").alias("step"), F.sum("groomings").alias("groomings"))


def write_day_changes(src: Sources, root: str, lo: date, hi: date, channel: str = "Both") -> str:
    """Store the ``day_changes`` of the visits in lo..hi, in a folder for each day; days stored before are replaced.

    A day's changes need its visits and those of the window before it, so appending a day reads a month, not the year. An
    invoice that comes late asks for its day and the 30 after it to be written again.
    """
    w = cfg.ROLLING_DAYS
    days = customer_days(src.at(hi), lo - timedelta(days=w), hi, channel)
    day_changes(days, w + 1).filter(F.col("on") >= F.lit(lo)).repartition("on") \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("on").parquet(root)
    return root


@at_day
def rolling_30d(src: Sources, as_of: date, channel: str = "Both", date_filter: str | None = "past12months~", months: int = 12,
                stored: str | None = None) -> DataFrame:
    """Q16: active customers and groomings over the inclusive window [d-30, d] for each day of the last ``months`` months
    (the chart's year); the date filter chooses among these days.

    One pass over the invoice summary: customer days, what they change by day, then two running windows over the day spine.
    With ``stored`` the changes are read from there (``write_day_changes`` of the same channel), and no invoice is.
    """
    w = cfg.ROLLING_DAYS
    start, end = add_months(as_of, -months), as_of
    first = start - timedelta(days=w)
    if stored is None:
        changes = day_changes(customer_days(src, first, end, channel), w + 1)
    else:
        changes = _spark(src).read.parquet(stored).filter(F.col("on").between(F.lit(first), F.lit(end)))
        changes = changes.filter(F.col("prev").isNull() | (F.col("prev") >= F.lit(first)))
    steps = changes.filter(F.col("day") <= F.lit(end)).groupBy("day").agg(F.sum("step").alias("step"), F.sum("groomings").alias("groomings"))
    so_far = Window.orderBy("Date").rowsBetween(Window.unboundedPreceding, 0)
    recent = Window.orderBy("Date").rowsBetween(-w, 0)
    out = spine(_spark(src), first, end, "Date").join(F.broadcast(steps), F.col("day") == F.col("Date"), "left").select(  # a row a day at most
        "Date", F.sum(F.coalesce("step", F.lit(0))).over(so_far).cast("bigint").alias("Active Customers (30D)"),
        F.sum(F.coalesce("groomings", F.lit(0))).over(recent).cast("double").alias("Groomings (30D)"),
    ).filter(F.col("Date") >= F.lit(start))
    rng = relative_range(date_filter, as_of)
    if rng is not None:
        out = out.filter(F.col("Date").between(F.lit(rng[0]), F.lit(rng[1])))
    return out.orderBy("Date")
