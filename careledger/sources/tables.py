"""Base tables (S1-S5) and the container that carries them through a query."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as cfg
from .agents import agent_emails, agent_phones, agents_frame, agents_of, load_agents

TABLES = ("sales_invoice", "sales_invoice_item", "customer", "customer_follow_up", "call_log")


@dataclass
class Sources:
    """The five retail tables plus the agent config.

    Any DataFrames with these columns work: parquet, Delta, JDBC or the
    fixture adapter (``sources.fixtures.load_fixture``).
    """

    sales_invoice: DataFrame
    sales_invoice_item: DataFrame
    customer: DataFrame
    customer_follow_up: DataFrame
    call_log: DataFrame
    agents: DataFrame
    agent_list: list[dict]
    as_of: date | None = None  # the accessors below hide what is dated later
    summary: DataFrame | None = None  # a stored ``operators.summary.invoice_totals``, used in place of the items

    def at(self, as_of: date) -> Sources:
        return self if self.as_of is not None and self.as_of <= as_of else replace(self, as_of=as_of)


def at_day(query):
    """A query (src, as_of, ...) that sees no row dated after ``as_of``."""

    @wraps(query)
    def run(src: Sources, as_of: date, *args, **params):
        return query(src.at(as_of), as_of, *args, **params)

    return run


def _agents(spark, agents: DataFrame | None, agent_list: list[dict] | None) -> dict:
    """Frame and list of the same agents, whichever is given; the configured file if neither is."""
    if agents is None:
        agent_list = agent_list or load_agents()
        return {"agents": agents_frame(spark, agent_list), "agent_list": agent_list}
    return {"agents": agents, "agent_list": agent_list or agents_of(agents)}


def read_tables(spark, root: str, agents: DataFrame | None = None, agent_list: list[dict] | None = None) -> Sources:
    """Retail tables stored as ``<root>/<table>`` parquet datasets."""
    frames = {t: spark.read.parquet(f"{root}/{t}") for t in TABLES}
    return Sources(**frames, **_agents(spark, agents, agent_list))


#: Derived when the tables are written, and optional in ``Sources``: the first of the month an invoice (of an item: its
#: invoice) was posted in, and whether an invoice has a grooming line.
MONTH, GROOMED = "posting_month", "has_grooming_line"


def derived(src: Sources) -> tuple[DataFrame, DataFrame]:
    """Invoices with MONTH and GROOMED, items with MONTH. An item without its invoice keeps a null month."""
    month = F.trunc("posting_date", "MM")
    groomed = src.sales_invoice_item.filter(F.col("item_group").isin(list(cfg.GROOMING_GROUPS))) \
        .groupBy(F.col("parent").alias("_parent")).agg(F.lit(True).alias(GROOMED))
    inv = src.sales_invoice.drop(MONTH, GROOMED).withColumn(MONTH, month)
    inv = inv.join(groomed, F.col("name") == F.col("_parent"), "left").drop("_parent").withColumn(GROOMED, F.coalesce(GROOMED, F.lit(False)))
    lines = src.sales_invoice_item
    if MONTH not in lines.columns:
        lines = lines.join(src.sales_invoice.select(F.col("name").alias("_name"), month.alias(MONTH)), F.col("parent") == F.col("_name"), "left").drop("_name")
    return inv, lines


def write_tables(src: Sources, root: str, mode: str = "overwrite") -> None:
    """Materialise the tables (e.g. the fixture adapter's output), or append rows to them.

    Invoices and items lie in a folder for each posting month, so a date range opens the same months of both; invoices
    are sorted by date in it, items by invoice. Both are dealt by ranges that begin with the month: a month is written by
    as many tasks as its rows ask for, and a task writes few months. Follow-ups are clustered by customer.
    """
    inv, lines = derived(src)
    inv.repartitionByRange(MONTH, "posting_date", "name").sortWithinPartitions(MONTH, "posting_date") \
        .write.mode(mode).partitionBy(MONTH).parquet(f"{root}/sales_invoice")
    lines.repartitionByRange(MONTH, "parent").sortWithinPartitions(MONTH, "parent") \
        .write.mode(mode).partitionBy(MONTH).parquet(f"{root}/sales_invoice_item")
    src.customer.write.mode(mode).parquet(f"{root}/customer")
    src.customer_follow_up.repartition("customer").sortWithinPartitions("customer", "creation") \
        .write.mode(mode).parquet(f"{root}/customer_follow_up")
    src.call_log.write.mode(mode).parquet(f"{root}/call_log")


BUCKET_KEYS = {"sales_invoice": "name", "sales_invoice_item": "parent", "customer_follow_up": "customer",
               "customer": "name"}


def write_bucketed(spark, src: Sources, root: str, buckets: int, database: str = "retail") -> None:
    """Store the tables as bucketed catalog tables (external, under ``root``).

    Invoices are bucketed by invoice id and items by parent with the same
    bucket count, so the fact-to-fact join and the per-invoice aggregates read
    co-partitioned files and shuffle neither side. Follow-ups and customers are
    bucketed by customer id for the per-customer aggregates. Each bucket is
    written by one task as one file, sorted by the join key.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    sort_keys = {"sales_invoice": ["name"], "sales_invoice_item": ["parent"],
                 "customer_follow_up": ["customer", "creation"], "customer": ["name"]}
    for t in TABLES:
        df = getattr(src, t)
        if t in BUCKET_KEYS:
            df = df.repartition(buckets, BUCKET_KEYS[t])
        w = df.write.mode("overwrite").format("parquet").option("path", f"{root}/{t}")
        if t in BUCKET_KEYS:
            w = w.bucketBy(buckets, BUCKET_KEYS[t]).sortBy(*sort_keys[t])
        w.saveAsTable(f"{database}.{t}")


def read_catalog(spark, database: str = "retail", agents: DataFrame | None = None,
                 agent_list: list[dict] | None = None) -> Sources:
    """Sources over catalog tables (e.g. those of ``write_bucketed``)."""
    frames = {t: spark.table(f"{database}.{t}") for t in TABLES}
    return Sources(**frames, **_agents(spark, agents, agent_list))


def _until(df: DataFrame, time: str, as_of: date | None) -> DataFrame:
    """Rows of a timestamp column up to the end of ``as_of``."""
    return df if as_of is None else df.filter(F.col(time) < F.lit(as_of + timedelta(days=1)).cast("timestamp_ntz"))


def _earlier(a: date | None, b: date | None) -> date | None:
    return min(x for x in (a, b) if x is not None) if a is not None or b is not None else None


def _of_months(df: DataFrame, lo: date | None, hi: date | None) -> DataFrame:
    """The months of the days lo..hi, where the table is laid out by month (these predicates prune its folders)."""
    if MONTH in df.columns:
        if lo is not None:
            df = df.filter(F.col(MONTH) >= F.lit(lo.replace(day=1)))
        if hi is not None:
            df = df.filter(F.col(MONTH) <= F.lit(hi.replace(day=1)))
    return df


def posted(df: DataFrame, lo: date | None, hi: date | None) -> DataFrame:
    """Rows with posting_date in lo..hi (None: open)."""
    if lo is not None:
        df = df.filter(F.col("posting_date") >= F.lit(lo))
    if hi is not None:
        df = df.filter(F.col("posting_date") <= F.lit(hi))
    return _of_months(df, lo, hi)


# Submitted invoices posted in lo..hi, none after as_of; all predicates reach the parquet scan.
def invoices(src: Sources, lo: date | None = None, hi: date | None = None) -> DataFrame:
    return posted(src.sales_invoice.filter(F.col("docstatus") == 1), lo, _earlier(hi, src.as_of))


# Items; of invoices posted in lo..hi at least, where the table is laid out by posting month.
def items(src: Sources, lo: date | None = None, hi: date | None = None) -> DataFrame:
    out = _of_months(src.sales_invoice_item, lo, _earlier(hi, src.as_of))
    return out.select("parent", "item_code", "item_group", "qty", "base_amount")


# S3
def customers(src: Sources) -> DataFrame:
    return src.customer.select("name", "customer_name")


# All follow-ups, or only those of configured agents (IN-list of config size).
def follow_ups(src: Sources, configured_only: bool = False) -> DataFrame:
    fu = _until(src.customer_follow_up, "creation", src.as_of)
    if configured_only:
        fu = fu.filter(F.col("agent").isin(agent_emails(src.agent_list)))
    return fu


# Call log of configured phones only.
def calls(src: Sources) -> DataFrame:
    return _until(src.call_log, "start_time", src.as_of).filter(F.col("agent_number").isin(agent_phones(src.agent_list)))
