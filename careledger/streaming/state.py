"""Per-customer state of the work queue (V6, V9-V15), recomputed for touched customers only.

The state has the day-independent facts of every customer with an invoice (``followups.customer_facts`` for all channels
and the latest follow-up) in a fixed number of buckets by customer. New rows touch some customers: their facts are
computed anew from their own rows, the buckets they lie in are written again beside the old ones, and a manifest that
lists the folder of each bucket is committed. The other buckets stay where they are.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.summary import invoice_totals
from ..plans.followups import IN_CHANNEL, customer_facts, latest_follow_up
from ..sources.tables import MONTH, Sources, follow_ups, invoices
from . import files

BUCKETS = 256
#: Up to so many touched customers are named in the scans' filters; more are met by a semi join.
NAMED = 10_000


def _bucket(customer="customer"):
    return F.pmod(F.xxhash64(customer), F.lit(BUCKETS)).cast("int")


def facts_of(src: Sources, only: DataFrame | None = None) -> DataFrame:
    """The facts of all customers with an invoice, or of those in ``only``."""
    totals = invoice_totals(src, only=only, without_lines=True)
    calls = latest_follow_up(src) if only is None else latest_follow_up(src, only)
    return customer_facts(totals, IN_CHANNEL).join(calls, "customer", "left")


def narrowed(src: Sources, touched: DataFrame) -> Sources:
    """``src`` with what the touched customers have: named in the filters of the scans while they are few, and only the
    posting months of their invoices (at most one value a month of the calendar)."""
    few = [r["customer"] for r in touched.limit(NAMED + 1).collect()]
    if len(few) <= NAMED:
        src = replace(src, sales_invoice=src.sales_invoice.filter(F.col("customer").isin(few)),
                      customer_follow_up=src.customer_follow_up.filter(F.col("customer").isin(few)))
    if MONTH in src.sales_invoice_item.columns:
        months = [r[0] for r in invoices(src).join(touched, "customer", "left_semi").select(MONTH).distinct().collect()]
        src = replace(src, sales_invoice_item=src.sales_invoice_item.filter(F.col(MONTH).isin(months)))
    return src


def read(spark: SparkSession, root: str) -> DataFrame | None:
    """The committed state, or None."""
    now = files.latest(spark, f"{root}/manifests")
    return None if now is None else _rows(spark, now, list(now["buckets"].values()))


def _rows(spark: SparkSession, now: dict, paths: list[str]) -> DataFrame:
    schema = T.StructType.fromJson(now["schema"])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _write(df: DataFrame, root: str) -> dict[str, str]:
    """Write rows by bucket; the folder of each bucket that has any."""
    spark, version = df.sparkSession, f"{root}/data/{uuid.uuid4().hex}"
    df.withColumn("bucket", _bucket()).repartition("bucket").write.partitionBy("bucket").parquet(version)
    return {n.removeprefix("bucket="): f"{version}/{n}" for n in files.names(spark, version) if n.startswith("bucket=")}


def refreshed(src: Sources, as_of: date, root: str, touched: DataFrame) -> DataFrame:
    """The state of ``as_of`` after the customers in ``touched`` (customer) got new rows, committed and read back.

    Customers with rows dated between the state's day and ``as_of`` are touched as well; without a state, or for an earlier
    day than the state's, all facts are computed.
    """
    spark, src = src.sales_invoice.sparkSession, src.at(as_of)
    now = files.latest(spark, f"{root}/manifests")
    if now is None or date.fromisoformat(now["as_of"]) > as_of:
        facts = facts_of(src)
        now = {"schema": facts.schema.jsonValue(), "buckets": _write(facts, root)}
    else:
        known = date.fromisoformat(now["as_of"])
        if known < as_of:
            since = follow_ups(src).filter(F.to_date("creation") > F.lit(known)).select("customer")
            dated = invoices(src, known).filter(F.col("posting_date") > F.lit(known)).select("customer")
            touched = touched.union(since).union(dated)
        touched = touched.filter("customer IS NOT NULL").distinct()
        hit = [str(r[0]) for r in touched.select(_bucket()).distinct().collect()]  # BUCKETS values at most
        own = narrowed(src, touched)
        new = facts_of(own, touched)
        old = _rows(spark, now, [now["buckets"][b] for b in hit if b in now["buckets"]]).join(touched, "customer", "left_anti")
        kept = {b: p for b, p in now["buckets"].items() if b not in hit}
        now = {"schema": now["schema"], "buckets": {**kept, **_write(old.unionByName(new), root)}}
    files.commit(spark, f"{root}/manifests", {"as_of": as_of.isoformat(), **now})
    gone = {p for m in files.forget_older(spark, f"{root}/manifests", 2) for p in m["buckets"].values()}
    live = {p for n in files.numbers(spark, f"{root}/manifests") for p in files.read_json(spark, f"{root}/manifests/{n:010d}.json")["buckets"].values()}
    for path in gone - live:
        files.delete(spark, path)
    return read(spark, root)
