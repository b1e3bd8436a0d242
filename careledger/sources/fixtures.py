"""Adapter from the driver's TPC-H-like parquet tables to the retail schema.

The mapping is the one in FIXTURES.md §2; the DuckDB oracle uses the same
expressions (careledger/oracle/duckdb_sql.py), so both engines see the same rows.
Everything here is a lazy projection / join over the scanned tables: Catalyst
prunes the columns each query needs and pushes the date cut into the scans.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_AS_OF
from .agents import agents_frame, load_agents
from .tables import MONTH, Sources

# --- Fixed values of the fixture mapping (FIXTURES.md §2) ---
EVENT_DAY_SHIFT = 8229  # moves 2024-01-01..30 to 2001-06-21..07-20
FIXTURE_AGENT_EMAILS = ("agent1@example.com", "agent2@example.com", "agent3@example.com",
                        "agent4@example.com", "other@example.com")
CALL_STATUSES = ("Answered", "ANSWER", "completed", "MISSED", "busy", "FAILED", "cancel",
                 "CANCELLED", "ChanUnavail", "ringing")
CALL_OUTCOMES = ("Connected", "No Answer", "Busy")
POS_BY_PRIORITY = (("1-URGENT", "Vennala POS"), ("2-HIGH", "Vennala POS"), ("3-MEDIUM", None),
                   ("4-NOT SPECIFIED", "  "), ("5-LOW", "Other POS"))
# --- end of fixed values ---


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts(d: date) -> Column:
    return F.lit(datetime(d.year, d.month, d.day)).cast("timestamp_ntz")


def _pick(index: Column, values: tuple) -> Column:
    """values[index] as a CASE chain (index is a small non-negative int)."""
    expr = None
    for i, v in enumerate(values):
        cond = index == i
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr


def _orders(spark: SparkSession, sf_dir: str, as_of: date) -> DataFrame:
    # o_orderdate is a midnight timestamp: "<= as_of" as a timestamp range keeps the
    # predicate pushable into the parquet scan.
    return _read(spark, sf_dir, "orders").filter(F.col("o_orderdate") < _ts(as_of + timedelta(days=1)))


def _base_amount() -> Column:
    return (F.col("l_extendedprice").cast("decimal(12,2)")
            * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)")


def sales_invoice_item(spark: SparkSession, sf_dir: str, as_of: date) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity",
                                                  "l_extendedprice", "l_discount")
    o = _orders(spark, sf_dir, as_of).select("o_orderkey", "o_custkey", "o_orderdate")
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_type")
    ck = F.col("o_custkey")
    ptype = F.col("p_type")
    food_accessory = (ck % 8) == 4
    item_group = (
        F.when((ck % 8) == 0, F.when(ptype == "MEDIUM", "Travel Services").otherwise("Grooming Services"))
        .when(ptype == "MEDIUM", F.when((ck % 4) == 1, "Accessories").otherwise("Grooming Services"))
        .when(ptype == "STANDARD", F.when((ck % 4) == 1, "Accessories").otherwise("Travel Services"))
        .when(ptype == "LARGE", F.when(food_accessory, "Accessories").otherwise("Dogs – Dry Food"))
        .when(ptype == "PROMO", F.when(food_accessory, "Accessories").otherwise("Cats – Treats"))
        .when(ptype == "SMALL", F.when(food_accessory, "Accessories").otherwise("Pet Food"))
        .otherwise("Accessories")
    )
    pk = F.col("p_partkey").cast("string")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(p, li.l_partkey == p.p_partkey)
        .select(
            F.col("l_orderkey").cast("string").alias("parent"),
            F.when((F.col("p_partkey") % 5) == 0, F.concat(F.lit("GRM-ADD-"), pk))
            .otherwise(F.concat(F.lit("GRM-"), pk)).alias("item_code"),
            item_group.alias("item_group"),
            F.col("l_quantity").cast("decimal(18,2)").alias("qty"),
            _base_amount().alias("base_amount"),
            F.trunc(F.to_date("o_orderdate"), "MM").alias(MONTH),
        )
    )


def sales_invoice(spark: SparkSession, sf_dir: str, as_of: date) -> DataFrame:
    o = _orders(spark, sf_dir, as_of)
    li = _read(spark, sf_dir, "lineitem")
    tax = F.col("l_tax").cast("decimal(4,2)")
    sums = li.groupBy("l_orderkey").agg(
        F.sum(_base_amount()).alias("net"),
        F.sum(_base_amount() * (F.lit(1) + tax)).alias("gross"),
    )
    prio = F.col("o_orderpriority")
    pos = F.lit(None).cast("string")
    for key, val in reversed(POS_BY_PRIORITY):
        pos = F.when(prio == key, F.lit(val).cast("string")).otherwise(pos)
    return (
        o.join(sums, o.o_orderkey == sums.l_orderkey, "left")
        .select(
            F.col("o_orderkey").cast("string").alias("name"),
            F.col("o_custkey").cast("string").alias("customer"),
            F.to_date("o_orderdate").alias("posting_date"),
            pos.alias("pos_profile"),
            F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).cast("int").alias("docstatus"),
            F.coalesce(F.col("gross"), F.lit(0)).cast("decimal(24,6)").alias("base_grand_total"),
            F.coalesce(F.col("net"), F.lit(0)).cast("decimal(24,4)").alias("base_net_total"),
        )
    )


def crm_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    return c.filter((F.col("c_custkey") % 97) != 0).select(
        F.col("c_custkey").cast("string").alias("name"),
        F.when((F.col("c_custkey") % 50) == 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_name")).alias("customer_name"),
    )


def _events(spark: SparkSession, sf_dir: str, as_of: date) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    shifted = F.col("ts") - F.expr(f"INTERVAL {EVENT_DAY_SHIFT} DAYS")
    return (
        ev.filter(F.col("ts") < _ts(as_of + timedelta(days=1 + EVENT_DAY_SHIFT)))
        .withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        .withColumn("shifted", shifted)
    )


def customer_follow_up(spark: SparkSession, sf_dir: str, as_of: date) -> DataFrame:
    ev = _events(spark, sf_dir, as_of).filter(F.col("event_type") == "signup")
    k = F.col("k")
    eid = F.col("event_id")
    return ev.select(
        F.lpad(eid.cast("string"), 10, "0").alias("name"),
        (F.col("user_id") * 10 + eid % 10).cast("string").alias("customer"),
        F.when(k % 3 == 0, F.lit("")).otherwise(F.lit(None).cast("string")).alias("customer_name"),
        _pick((eid % 5).cast("int"), FIXTURE_AGENT_EMAILS).alias("agent"),
        F.col("shifted").alias("creation"),
        F.when(k % 4 == 0, F.lit(None).cast("date"))
        .otherwise(F.date_add(F.to_date("shifted"), (k % 20).cast("int"))).alias("next_follow_up"),
        _pick((k % 3).cast("int"), CALL_OUTCOMES).alias("call_outcome"),
        F.when(k % 2 == 0, F.lit(" ")).otherwise(F.concat(F.lit("note "), k.cast("string"))).alias("quick_note"),
        F.when(k % 10 == 1, F.lit("Not interested")).when(k % 10 == 2, F.lit(""))
        .otherwise(F.lit(None).cast("string")).alias("no_follow_up_reason"),
        F.lit(None).cast("string").alias("no_follow_up_details"),
    )


def call_log(spark: SparkSession, sf_dir: str, as_of: date) -> DataFrame:
    ev = _events(spark, sf_dir, as_of).filter(F.col("event_type") != "signup")
    return ev.select(
        F.concat(F.lit("91000000000"), (F.col("event_id") % 5 + 1).cast("string")).alias("agent_number"),
        F.col("shifted").alias("start_time"),
        _pick((F.col("k") % 10).cast("int"), CALL_STATUSES).alias("status"),
    )


def load_fixture(spark: SparkSession, sf_dir: str, as_of: date = DEFAULT_AS_OF) -> Sources:
    """All retail tables over one scale-factor directory, cut at ``as_of``."""
    return Sources(
        sales_invoice=sales_invoice(spark, sf_dir, as_of),
        sales_invoice_item=sales_invoice_item(spark, sf_dir, as_of),
        customer=crm_customer(spark, sf_dir),
        customer_follow_up=customer_follow_up(spark, sf_dir, as_of),
        call_log=call_log(spark, sf_dir, as_of),
        agents=agents_frame(spark),
        agent_list=load_agents(),
    )
