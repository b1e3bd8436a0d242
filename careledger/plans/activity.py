"""Agent activity and follow-up logs (Q35-Q40).

Agent lookups are CASE expressions over the handful of configured agents
(config-sized literals, no join); agent filters are IN-lists that reach the
parquet scan as pushed filters.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as cfg
from ..functions.exprs import agent_name_case, call_bucket
from ..functions.params import month_start, period_bounds
from ..operators.position import in_order
from ..sources.tables import at_day, calls, customers, follow_ups, Sources

BUCKET_COLUMNS = {"answered": "Answered", "missed": "Missed", "busy": "Busy", "failed": "Failed",
                  "cancelled": "Cancelled", "unavailable": "Unavailable"}


def combined_activity(src: Sources) -> DataFrame:
    """Configured agents' calls ∪ follow-ups with bucket flags."""
    agents = src.agent_list
    c = calls(src).select(
        agent_name_case("agent_number", agents, "phone").alias("agent_name"),
        F.col("start_time"), F.lit(1).alias("is_call"), F.lit(0).alias("is_followup"),
        *[call_bucket("status", values).alias(name) for name, values in cfg.CALL_STATUS_BUCKETS],
    )
    f = follow_ups(src, configured_only=True).select(
        agent_name_case("agent", agents, "email").alias("agent_name"),
        F.col("creation").alias("start_time"), F.lit(0).alias("is_call"), F.lit(1).alias("is_followup"),
        *[F.lit(0).alias(name) for name, _ in cfg.CALL_STATUS_BUCKETS],
    )
    return c.unionByName(f)


@at_day
def agent_activity(src: Sources, as_of: date, period: str = "Today") -> DataFrame:
    """Q35: follow-ups and call outcomes per agent in a named period."""
    lo, hi = period_bounds(period, as_of)
    # Day bounds as a timestamp range so the filter reaches both scans.
    lo_ts = F.lit(lo).cast("timestamp_ntz")
    hi_ts = F.lit(hi + timedelta(days=1)).cast("timestamp_ntz")
    act = combined_activity(src).filter((F.col("start_time") >= lo_ts) & (F.col("start_time") < hi_ts))
    return (
        act.groupBy(F.col("agent_name").alias("Agent"))
        .agg(F.sum("is_followup").alias("Total Follow-ups"),
             *[F.sum(k).alias(v) for k, v in BUCKET_COLUMNS.items()],
             F.sum("is_call").alias("Total Voxbay Calls"))
        .orderBy(F.col("Total Follow-ups").desc(), F.col("Total Voxbay Calls").desc())
    )


def _mtd_follow_ups(src: Sources, as_of: date) -> DataFrame:
    """Follow-ups of configured agents from the 1st through today (included)."""
    lo = F.lit(month_start(as_of)).cast("timestamp_ntz")
    hi = F.lit(as_of + timedelta(days=1)).cast("timestamp_ntz")
    return follow_ups(src, configured_only=True).filter((F.col("creation") >= lo) & (F.col("creation") < hi))


@at_day
def followups_mtd_by_agent(src: Sources, as_of: date, position: bool = False) -> DataFrame:
    """Q36: month-to-date follow-ups per configured agent (agents with none are
    dropped by the inner join), in config order."""
    counts = _mtd_follow_ups(src, as_of).groupBy("agent").agg(F.count(F.lit(1)).alias("Follow-ups"))
    rows = F.broadcast(src.agents).join(counts, F.col("email") == F.col("agent")).select(F.col("name").alias("Agent"), "Follow-ups", "ordinal")
    return in_order(rows, [F.asc("ordinal")], position, ("ordinal",))


@at_day
def followups_mtd_total(src: Sources, as_of: date) -> DataFrame:
    """Q37."""
    return _mtd_follow_ups(src, as_of).agg(F.count(F.lit(1)).alias("Count"))


def _day_follow_ups(src: Sources, day: date) -> DataFrame:
    lo = F.lit(day).cast("timestamp_ntz")
    hi = F.lit(day + timedelta(days=1)).cast("timestamp_ntz")
    return follow_ups(src, configured_only=True).filter((F.col("creation") >= lo) & (F.col("creation") < hi))


@at_day
def followups_done_on_day(src: Sources, as_of: date, followup_day: date | None = None) -> DataFrame:
    """Q38: follow-ups logged on the chosen day (default as_of)."""
    return _day_follow_ups(src, followup_day or as_of).agg(F.count(F.lit(1)).alias("Count"))


@at_day
def followups_avg_daily(src: Sources, as_of: date) -> DataFrame:
    """Q39: month-to-date follow-ups per day (today included), one decimal."""
    days = float(max((as_of - month_start(as_of)).days + 1, 1))
    return _mtd_follow_ups(src, as_of).agg(
        F.round(F.count(F.lit(1)).cast("double") / F.lit(days), 1).alias("Count"))


@at_day
def followups_on_day_log(src: Sources, as_of: date, followup_day: date | None = None, position: bool = False) -> DataFrame:
    """Q40: the day's follow-ups, newest first (of one time: by follow-up id)."""
    fu = _day_follow_ups(src, followup_day or as_of)
    # Only the day's customers are needed from the (large) customer dimension:
    # a semi join first, so AQE can broadcast the small sides at run time.
    cust = customers(src).join(fu.select(F.col("customer").alias("name")), "name", "left_semi") \
        .select(F.col("name").alias("c_name"), F.col("customer_name").alias("c_customer_name"))
    rows = (
        fu.join(cust, F.col("customer") == F.col("c_name"), "left")
        .select(
            F.date_format("creation", "HH:mm").alias("Time"),
            agent_name_case("agent", src.agent_list, "email", "agent").alias("Agent"),
            F.coalesce(F.nullif(F.trim("customer_name"), F.lit("")), F.col("c_customer_name"),
                       F.col("customer")).alias("Customer"),
            F.col("customer").alias("Customer ID"),
            F.col("call_outcome").alias("Outcome"),
            F.nullif(F.trim("quick_note"), F.lit("")).alias("Notes"),
            F.col("next_follow_up").alias("Next Follow-up"),
            F.col("creation").alias("_creation"), F.col("name").alias("_name"),
        )
    )
    return in_order(rows, [F.desc("_creation"), F.asc("_name")], position, ("_creation", "_name"))
