"""One row per submitted invoice with what every card needs of its lines.

All facts of an invoice's lines are fixed-width sums, counts and flags, so one aggregate by invoice id serves sales,
grooming counts, the work queue and the customer table. Columns a card does not use are pruned from the aggregate.

Without a restriction the items are totalled first, by ``parent``: what is shuffled is one row an invoice, not its lines,
and the join to the invoices keeps that partitioning. With ``only`` (a set of customers) the invoices are restricted
first, so lines of other customers reach no aggregate.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as cfg
from ..functions.exprs import is_grooming_group, smart_qty, sql_in, sql_lit
from ..functions.params import where
from ..session import checkpoint_dir
from ..sources.tables import MONTH, Sources, invoices, items, posted

FOOD_FLAGS = [(f"_food{i}", group, label) for i, (group, label) in enumerate(cfg.FOOD_TYPES)]
_GROOM_LIKE = "(item_group LIKE '%Grooming%' OR item_group LIKE '%Service%')"


def line_totals() -> list[Column]:
    """Aggregates over the lines of one invoice; ``n_lines`` is 0 where an outer join brought none."""
    groom, other = is_grooming_group(), ~F.coalesce(is_grooming_group(), F.lit(False))  # C2: a line without a group is a product
    amount = F.col("base_amount")

    def flag(condition: str) -> Column:
        return F.expr(f"max(CASE WHEN {condition} THEN 1 ELSE 0 END)")

    return [
        F.count("parent").alias("n_lines"),
        F.sum(amount).alias("base_sum"),
        F.sum(F.when(groom, amount)).alias("grooming_base"),
        F.count(F.when(groom, F.lit(1))).alias("grooming_lines"),
        F.sum(F.when(other, amount)).alias("product_base"),
        F.count(F.when(other, F.col("parent"))).alias("product_lines"),
        smart_qty().alias("smart_qty"),
        flag(f"item_group NOT IN {sql_in(cfg.GROOMING_GROUPS)}").alias("product_line"),
        flag(f"item_group IN {sql_in(cfg.FOOD_GROUPS)}").alias("food_line"),
        flag(_GROOM_LIKE).alias("groom_like"),
        flag(f"NOT {_GROOM_LIKE}").alias("product_like"),
        *[flag(f"item_group = {sql_lit(group)}").alias(name) for name, group, _ in FOOD_FLAGS],
    ]


INVOICE = ("name", "customer", "posting_date", "pos_profile", "base_grand_total")


def invoice_totals(src: Sources, lo: date | None = None, hi: date | None = None, pred: Column | None = None,
                   only: DataFrame | None = None, without_lines: bool = False) -> DataFrame:
    """INVOICE columns and ``line_totals`` of each submitted invoice posted in lo..hi that meets ``pred``, of the customers
    in ``only`` if given. Invoices without lines come with ``n_lines`` 0 if asked for, else not at all. Read from the
    stored summary where ``src`` has one."""
    if src.summary is not None:
        hi = min(x for x in (hi, src.as_of) if x is not None) if hi or src.as_of else None
        out = where(posted(src.summary, lo, hi), pred)
        out = out if only is None else out.join(only, "customer", "left_semi")
        return out if without_lines else out.filter(F.col("n_lines") > 0)
    inv = where(invoices(src, lo, hi), pred).select(*INVOICE)
    lines, same = items(src, lo, hi), F.col("parent") == F.col("name")
    how = "left" if without_lines else "inner"
    if only is not None:
        return inv.join(only, "customer", "left_semi").join(lines, same, how).groupBy(*INVOICE).agg(*line_totals())
    out = inv.join(lines.groupBy("parent").agg(*line_totals()), same, how).drop("parent")
    return out.withColumn("n_lines", F.coalesce("n_lines", F.lit(0))) if without_lines else out


def with_summary(src: Sources, root: str | None = None) -> Sources:
    """``src`` with its summary stored by posting month under ``root`` (else in the shared folder): what reads it reads no
    items, and a lost executor recomputes none of it."""
    spark = src.sales_invoice.sparkSession
    path = os.path.join(root or checkpoint_dir(spark), f"invoice_totals_{uuid.uuid4().hex}")
    totals = invoice_totals(src, without_lines=True).withColumn(MONTH, F.trunc("posting_date", "MM"))
    totals.repartitionByRange(MONTH, "name").write.partitionBy(MONTH).parquet(path)
    return replace(src, summary=spark.read.parquet(path))
