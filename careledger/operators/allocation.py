"""Invoice lines with tax allocated to each line (V1 + W1).

Every line gets its share of the invoice's tax:
``line + (grand - Σline) * line / Σline`` (NULL when Σline = 0).

Σline is computed with a ``groupBy(invoice)`` (partial aggregation, safe
even for a hot invoice) and joined back on the invoice key. The join of items
to invoices already hash-partitions both sides by invoice id, so the
aggregate and the second join reuse that partitioning: two exchanges in
total (items, invoices). Σline is taken **before** any line-level filter (the
reference's window runs over the whole invoice).

The allocated amount is computed in double in a fixed operation order and
carried as a decimal of 1/100 paisa, so sums over lines are exact and do not
depend on the order of addition.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.params import where
from ..sources.tables import Sources, invoices, items
from .summary import invoice_totals

GROSS = "gross_with_tax"
#: Allocated amounts, exact to 1/100 paisa; sums of them have 38 digits.
ALLOCATED = "decimal(28,4)"


def allocated(line: Column, grand: Column, line_sum: Column) -> Column:
    b = line.cast("double")
    g = grand.cast("double")
    s = line_sum.cast("double")
    return (b + (g - s) * (b / F.nullif(s, F.lit(0.0)))).cast(ALLOCATED)


def invoice_lines(src: Sources, lo: date | None = None, hi_excl: date | None = None,
                  invoice_pred: Column | None = None,
                  invoice_cols: tuple[str, ...] = ("posting_date", "pos_profile")) -> DataFrame:
    """Lines of submitted invoices with posting_date in [lo, hi_excl), plus the
    allocated gross ``gross_with_tax`` and the requested invoice columns."""
    hi = None if hi_excl is None else hi_excl - timedelta(days=1)
    keep = tuple(dict.fromkeys(("name", "base_grand_total") + tuple(invoice_cols)))
    inv = where(invoices(src, lo, hi), invoice_pred).select(*keep)
    lines = items(src, lo, hi).join(inv, F.col("parent") == F.col("name"))
    sums = lines.groupBy("parent").agg(F.sum("base_amount").alias("_line_sum"))
    out = lines.join(sums, "parent")
    return out.withColumn(GROSS, allocated(F.col("base_amount"), F.col("base_grand_total"), F.col("_line_sum"))) \
        .drop("_line_sum")


def allocated_part(summary_part: str) -> Column:
    """Tax-allocated gross of one part of an invoice (Σ of its lines' W1 shares)."""
    return allocated(F.col(summary_part), F.col("base_grand_total"), F.col("base_sum"))


def invoice_categories(src: Sources, lo: date | None = None, hi_excl: date | None = None,
                       invoice_pred: Column | None = None,
                       invoice_cols: tuple[str, ...] = ("posting_date", "pos_profile")) -> DataFrame:
    """Tax-allocated gross per (invoice, category) for the categories an
    invoice has lines in: ``B_c + (G - S) * B_c / S``, the exact sum of the
    per-line allocations of that category (W1)."""
    from ..config import CATEGORY_GROOMING, CATEGORY_PRODUCT

    summ = invoice_totals(src, lo, None if hi_excl is None else hi_excl - timedelta(days=1), invoice_pred)
    parts = F.array(
        F.when(F.col("grooming_lines") > 0,
               F.struct(F.lit(CATEGORY_GROOMING).alias("category"), allocated_part("grooming_base").alias("g"))),
        F.when(F.col("product_lines") > 0,
               F.struct(F.lit(CATEGORY_PRODUCT).alias("category"), allocated_part("product_base").alias("g"))),
    )
    keep = tuple(dict.fromkeys(("name",) + tuple(invoice_cols)))
    return summ.select(*keep, "smart_qty", F.explode(parts).alias("p")).filter(F.col("p").isNotNull()) \
        .select(*keep, "smart_qty", F.col("p.category").alias("category"), F.col("p.g").alias(GROSS))
