"""Column expressions: classifiers (C1-C18), the grooming count rule (A6),
ordered distinct lists (A7) and the Indian-rupee formatter (F22).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Given column *names*, each is built as one SQL expression (``F.expr``): a
single JVM call instead of one per sub-expression, which keeps query
construction cheap. Given ``Column`` objects, they compose Columns.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as cfg


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def sql_lit(v) -> str:
    """SQL literal of a string, number or date."""
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, date):
        return f"DATE'{v.isoformat()}'"
    return str(v)


def sql_in(values) -> str:
    return "(" + ", ".join(sql_lit(v) for v in values) + ")"


# Grouping channel. Named POS profile -> store, everything else -> truck.
def channel2(pos_profile: str | Column = "pos_profile", store_label: str = cfg.STORE_LABEL) -> Column:
    if isinstance(pos_profile, str):
        return F.expr(f"CASE WHEN {sql_name(pos_profile)} = {sql_lit(cfg.STORE_POS_PROFILE)} "
                      f"THEN {sql_lit(store_label)} ELSE {sql_lit(cfg.TRUCK_LABEL)} END")
    return F.when(pos_profile == cfg.STORE_POS_PROFILE, F.lit(store_label)).otherwise(F.lit(cfg.TRUCK_LABEL))


def is_store(pos_profile: str | Column = "pos_profile") -> Column:
    if isinstance(pos_profile, str):
        return F.expr(f"{sql_name(pos_profile)} = {sql_lit(cfg.STORE_POS_PROFILE)}")
    return pos_profile == cfg.STORE_POS_PROFILE


def is_blank(c: str | Column) -> Column:
    """NULL, empty or spaces only (IFNULL(NULLIF(TRIM(c), ''), '') = '')."""
    if isinstance(c, str):
        return F.expr(f"coalesce(trim({sql_name(c)}), '') = ''")
    return F.coalesce(F.trim(c), F.lit("")) == ""


# Sales category of a line.
def is_grooming_group(item_group: str | Column = "item_group") -> Column:
    if isinstance(item_group, str):
        return F.expr(f"{sql_name(item_group)} IN {sql_in(cfg.GROOMING_GROUPS)}")
    return item_group.isin(*cfg.GROOMING_GROUPS)


# Smart grooming quantity of one invoice (use inside .agg()).
def smart_qty(item_group: str = "item_group", item_code: str = "item_code", qty: str = "qty") -> Column:
    """Σ qty of base grooming lines when positive, else the largest add-on qty."""
    g = f"{sql_name(item_group)} = {sql_lit(cfg.GROOMING_SERVICES)}"
    add = f"contains({sql_name(item_code)}, {sql_lit(cfg.ADD_ON_MARKER)})"
    base = f"sum(CASE WHEN {g} AND NOT {add} THEN {sql_name(qty)} ELSE 0 END)"
    return F.expr(f"CASE WHEN {base} > 0 THEN {base} "
                  f"ELSE max(CASE WHEN {g} AND {add} THEN {sql_name(qty)} ELSE 0 END) END")


# C10: 'Grooming', 'Products', both or NULL from 0/1 flags.
def buys(has_grooming: str = "has_grooming", has_products: str = "has_products") -> Column:
    g = f"coalesce({sql_name(has_grooming)}, 0) = 1"
    p = f"coalesce({sql_name(has_products)}, 0) = 1"
    return F.expr(f"CASE WHEN {g} AND {p} THEN 'Grooming, Products' WHEN {g} THEN 'Grooming' "
                  f"WHEN {p} THEN 'Products' END")


# Call status bucket flag.
def call_bucket(status: str, values: tuple[str, ...]) -> Column:
    return F.expr(f"CASE WHEN upper({sql_name(status)}) IN {sql_in(values)} THEN 1 ELSE 0 END")


# Agent name by email or phone; the agents list is config-sized.
def agent_name_case(key: str, agents: list[dict], by: str = "email", fallback: str | None = None) -> Column:
    """CASE over the configured agents (a handful of literals, no join);
    ``fallback`` is a column name (default: the literal 'Unknown')."""
    whens = " ".join(f"WHEN {sql_lit(a[by])} THEN {sql_lit(a['name'])}" for a in agents if a[by])
    fb = sql_name(fallback) if fallback else "'Unknown'"
    return F.expr(f"CASE {sql_name(key)} {whens} ELSE {fb} END") if whens else F.expr(fb)


# D3: division that gives NULL on a zero divisor, in double.
def safe_div(a: Column, b: Column) -> Column:
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


# Percentage with one decimal, NULL when the base is zero.
def pct(a: Column, b: Column) -> Column:
    return F.round(F.lit(100.0) * a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0)), 1)


def money(c: Column, digits: int = 0) -> Column:
    """Exact decimal rounding (half away from zero), then double for output."""
    return F.round(c, digits).cast("double")


# '₹' + Indian digit grouping; NULL stays NULL, negative amounts are not grouped.
#: Places within a digit string that get a comma: 3, 5 and 7 digits before its end.
INR_COMMAS = "(?<=^[0-9]{1,18})(?=([0-9]{2}){0,2}[0-9]{3}$)"


def inr_sql(x: str) -> str:
    """The formatter as Spark SQL text over the SQL expression ``x``."""
    return f"concat('₹', regexp_replace(CAST(CAST(round({x}) AS BIGINT) AS STRING), '{INR_COMMAS}', ','))"


def inr(amount: Column | str) -> Column:
    """₹ formatting of a column (by name: one SQL expression, parsed JVM-side)."""
    if isinstance(amount, str):
        return F.expr(inr_sql(sql_name(amount)))
    return F.concat(F.lit("₹"), F.regexp_replace(F.round(amount, 0).cast("bigint").cast("string"), INR_COMMAS, ","))
