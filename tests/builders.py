"""Build small retail ``Sources`` from Python rows (hand-written edge cases)."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import types as T

from careledger.sources.agents import agents_frame, load_agents
from careledger.sources.tables import Sources

S, D, I = T.StringType(), T.DateType(), T.IntegerType()

INVOICE = T.StructType([
    T.StructField("name", S), T.StructField("customer", S), T.StructField("posting_date", D),
    T.StructField("pos_profile", S), T.StructField("docstatus", I),
    T.StructField("base_grand_total", T.DecimalType(24, 6)), T.StructField("base_net_total", T.DecimalType(24, 4)),
])
ITEM = T.StructType([
    T.StructField("parent", S), T.StructField("item_code", S), T.StructField("item_group", S),
    T.StructField("qty", T.DecimalType(18, 2)), T.StructField("base_amount", T.DecimalType(18, 4)),
])
CUSTOMER = T.StructType([T.StructField("name", S), T.StructField("customer_name", S)])
FOLLOW_UP = T.StructType([
    T.StructField("name", S), T.StructField("customer", S), T.StructField("customer_name", S),
    T.StructField("agent", S), T.StructField("creation", T.TimestampNTZType()), T.StructField("next_follow_up", D),
    T.StructField("call_outcome", S), T.StructField("quick_note", S), T.StructField("no_follow_up_reason", S),
    T.StructField("no_follow_up_details", S),
])
CALL = T.StructType([T.StructField("agent_number", S), T.StructField("start_time", T.TimestampNTZType()),
                     T.StructField("status", S)])

STORE = "Vennala POS"


def inv(name, customer, day: date, grand, net=None, pos=STORE, docstatus=1):
    grand = Decimal(str(grand))
    net = Decimal(str(net if net is not None else grand))
    return (name, customer, day, pos, docstatus, grand, net)


def item(parent, amount, group="Grooming Services", code="GRM-1", qty=1):
    return (parent, code, group, Decimal(str(qty)), Decimal(str(amount)))


def fu(name, customer, created: datetime, next_day: date | None, reason=None, agent="agent1@example.com"):
    return (name, customer, None, agent, created, next_day, "Connected", " ", reason, None)


def sources(spark, invoices=(), items=(), customers=None, follow_ups=(), calls=()) -> Sources:
    if customers is None:
        customers = sorted({(r[1], f"Customer {r[1]}") for r in invoices} | {(r[1], f"Customer {r[1]}")
                                                                              for r in follow_ups})
    return Sources(
        sales_invoice=spark.createDataFrame(list(invoices), INVOICE),
        sales_invoice_item=spark.createDataFrame(list(items), ITEM),
        customer=spark.createDataFrame(list(customers), CUSTOMER),
        customer_follow_up=spark.createDataFrame(list(follow_ups), FOLLOW_UP),
        call_log=spark.createDataFrame(list(calls), CALL),
        agents=agents_frame(spark),
        agent_list=load_agents(),
    )
