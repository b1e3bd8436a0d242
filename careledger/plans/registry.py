"""Registry of the user-level queries: name -> (Spark builder, DuckDB oracle).

Each Spark builder takes (spark, sf_dir) and runs over the whole fixture
tables at the fixed ``as_of``; parameter variants are registered as their
own names so every predicate builder is exercised.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT_AS_OF
from ..oracle import duckdb_sql as o
from ..sources.fixtures import load_fixture
from ..sources.tables import Sources
from . import activity, customers, followups as fq, sales


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[..., DataFrame]  # (src, as_of, **params)
    params: dict
    oracle: Callable[..., str] | None  # (as_of, **params) -> SQL


def _q(name, build, oracle=None, **params) -> Query:
    return Query(name, build, params, oracle)


def _drill_cell(as_of: date, cohort: date, months_since: int) -> str:
    return o.q21(as_of, cohort_month=cohort, months_since=months_since)


def _drill_roster(as_of: date, cohort: date) -> str:
    return o.q22(as_of, cohort_month=cohort)


QUERIES: list[Query] = [
    _q("q01_channel_sales_table", sales.channel_sales_table, o.q01),
    _q("q01_channel_sales_table_first_half_2001", sales.channel_sales_table, o.q01, start_date=date(2001, 1, 1), end_date=date(2001, 6, 30)),
    _q("q02_channel_sales_wide", sales.channel_sales_wide, o.q02),
    _q("q02_channel_sales_wide_from_2001", sales.channel_sales_wide, o.q02, start_date=date(2001, 1, 1)),
    _q("q03_channel_sales_stacked", sales.channel_sales_stacked, o.q03),
    _q("q03_channel_sales_stacked_to_1996", sales.channel_sales_stacked, o.q03, end_date=date(1996, 12, 31)),
    _q("q04_daily_sales_by_channel", sales.daily_sales_by_channel, o.q04),
    _q("q05_past7_daily_sales", sales.past7_daily_sales, o.q05),
    _q("q06_past7_daily_sales_detail", sales.past7_daily_sales_detail, o.q06),
    _q("q07_mtd_revenue", sales.mtd_revenue, o.q07),
    _q("q08_mtd_groomings", sales.mtd_groomings, o.q08),
    _q("q09_avg_daily_revenue", sales.avg_daily_revenue, o.q09),
    _q("q10_mtd_revenue_by_channel_category", sales.mtd_revenue_by_channel_category, o.q10),
    _q("q10_mtd_revenue_by_channel_category_in_order", sales.mtd_revenue_by_channel_category, o.q10, position=True),
    _q("q11_mtd_grooming_scorecard", sales.mtd_grooming_scorecard, o.q11),
    _q("q12_mtd_vs_projection", sales.mtd_vs_projection, o.q12),
    _q("q13_projected_month_end_sales", sales.projected_month_end_sales, o.q13),
    _q("q14_avg_daily_grooming_revenue", sales.avg_daily_grooming_revenue, o.q14),
    _q("q15_avg_daily_revenue_per_grooming", sales.avg_daily_revenue_per_grooming, o.q15),
    _q("q16_rolling_30d", sales.rolling_30d, o.q16),
    _q("q16_rolling_30d_store", sales.rolling_30d, o.q16, channel="Store"),
    _q("q17_monthly_new_customers", customers.monthly_new_customers, o.q17),
    _q("q17_monthly_new_customers_truck_all_time", customers.monthly_new_customers, o.q17,
       channel="Truck", date_filter="past120months~"),
    _q("q18_returning_customers_mtd", customers.returning_customers_mtd, o.q18),
    _q("q18_returning_customers_mtd_store", customers.returning_customers_mtd, o.q18, channel="Store"),
    _q("q19_monthly_retention_trend", customers.monthly_retention_trend, o.q19),
    _q("q19_monthly_retention_trend_truck", customers.monthly_retention_trend, o.q19, channel="Truck"),
    _q("q20_cohort_retention", customers.cohort_retention, o.q20),
    _q("q20_cohort_retention_store", customers.cohort_retention, o.q20, channel="Store"),
    _q("q21_cohort_cell_customers", customers.cohort_cell_customers, o.q21,
       cohort_month=date(1995, 1, 1), months_since=6),
    _q("q21_cohort_cell_customers_in_order", customers.cohort_cell_customers, o.q21,
       cohort_month=date(1995, 1, 1), months_since=6, position=True),
    _q("q21_cohort_cell_customers_unset", customers.cohort_cell_customers, o.q21),
    _q("q21_cohort_cell_customers_truck_month_1", customers.cohort_cell_customers, o.q21, channel="Truck",
       cohort_month=date(1995, 3, 1), months_since=1),
    _q("q22_cohort_roster", customers.cohort_roster, o.q22, cohort_month=date(1995, 2, 1)),
    _q("q22_cohort_roster_in_order", customers.cohort_roster, o.q22, cohort_month=date(1995, 2, 1), position=True),
    _q("p16_cohort_drill_cell", customers.stored_drill, _drill_cell, cohort=date(1995, 1, 1), months_since=6),
    _q("p16_cohort_drill_roster", customers.stored_drill, _drill_roster, cohort=date(1995, 2, 1)),
    _q("q23_customer_profile_v1", fq.customer_profile_v1, o.q23),
    _q("q23_customer_profile_v1_store_grooming_2001", fq.customer_profile_v1, o.q23, date_from=date(2001, 1, 1),
       date_to=date(2001, 7, 20), channel="Store", purchase_profile="Grooming only"),
    _q("q24_followup_queue", fq.followup_queue, o.q24),
    _q("q24_followup_queue_show_won", fq.followup_queue, o.q24, show_closed_won="Show"),
    _q("q24_followup_queue_truck_dormant_lost", fq.followup_queue, o.q24, channel="Truck",
       cohort="Dormant + Lost", food_buyer="Yes"),
    _q("q24_followup_queue_store_cross_sell", fq.followup_queue, o.q24, channel="Store",
       purchase_profile="Grooming & Products", cross_sell_segment_filter="Grooming only",
       food_opportunity_filter="Cross-sell food"),
    _q("q24_followup_queue_lost_resupply", fq.followup_queue, o.q24, cohort="Lost (90+ days)",
       food_opportunity_filter="Resupply due", cross_sell_segment_filter="Both"),
    _q("q24_followup_queue_in_order", fq.followup_queue, o.q24, position=True),
    _q("q24_followup_queue_show_won_in_order", fq.followup_queue, o.q24, show_closed_won="Show", position=True),
    _q("q24_followup_queue_food_only", fq.followup_queue, o.q24, cross_sell_segment_filter="Food only", show_closed_won="Show"),
    _q("q24_followup_queue_neither", fq.followup_queue, o.q24, cross_sell_segment_filter="Neither", food_buyer="No"),
    _q("q24_followup_queue_no_opportunity", fq.followup_queue, o.q24, food_opportunity_filter="None"),
    _q("q25_kpi_due_today", fq.kpi_due_today, o.q25),
    _q("q26_kpi_past_due", fq.kpi_past_due, o.q26),
    _q("q27_kpi_never_called", fq.kpi_never_called, o.q27),
    _q("q28_kpi_future_calls", fq.kpi_future_calls, o.q28),
    _q("q29_kpi_missing_date", fq.kpi_missing_date, o.q29),
    _q("q30_kpi_food_cross_sell", fq.kpi_food_cross_sell, o.q30),
    _q("q31_kpi_food_resupply", fq.kpi_food_resupply, o.q31),
    _q("q32_kpi_total_in_queue", fq.kpi_total_in_queue, o.q32),
    _q("q32_kpi_total_in_queue_show_won", fq.kpi_total_in_queue, o.q32, show_closed_won="Show"),
    _q("q32_kpi_total_in_queue_store_products", fq.kpi_total_in_queue, o.q32, channel="Store",
       purchase_profile="Products only"),
    _q("q26_kpi_past_due_truck_dormant", fq.kpi_past_due, o.q26, channel="Truck", cohort="Dormant (45-90 days)"),
    _q("q33_overdue_followups", fq.overdue_followups, o.q33),
    _q("q34_overdue_trend", fq.overdue_trend, o.q34),
    _q("q34_overdue_trend_store_grooming", fq.overdue_trend, o.q34, channel="Store", purchase_profile="Grooming only"),
    _q("q34_overdue_trend_truck_lost", fq.overdue_trend, o.q34, channel="Truck", cohort="Lost (90+ days)"),
    _q("q35_agent_activity", activity.agent_activity, o.q35),
    _q("q35_agent_activity_past_30_days", activity.agent_activity, o.q35, period="Past 30 days"),
    _q("q35_agent_activity_yesterday", activity.agent_activity, o.q35, period="Yesterday"),
    _q("q35_agent_activity_past_7_days", activity.agent_activity, o.q35, period="Past 7 days"),
    _q("q35_agent_activity_this_month", activity.agent_activity, o.q35, period="This month"),
    _q("q36_followups_mtd_by_agent", activity.followups_mtd_by_agent, o.q36),
    _q("q36_followups_mtd_by_agent_in_order", activity.followups_mtd_by_agent, o.q36, position=True),
    _q("q37_followups_mtd_total", activity.followups_mtd_total, o.q37),
    _q("q38_followups_done_on_day", activity.followups_done_on_day, o.q38),
    _q("q38_followups_done_on_day_0712", activity.followups_done_on_day, o.q38, followup_day=date(2001, 7, 12)),
    _q("q39_followups_avg_daily", activity.followups_avg_daily, o.q39),
    _q("q40_followups_on_day_log", activity.followups_on_day_log, o.q40),
    _q("q40_followups_on_day_log_in_order", activity.followups_on_day_log, o.q40, position=True),
    _q("q40_followups_on_day_log_0705", activity.followups_on_day_log, o.q40, followup_day=date(2001, 7, 5)),
]


def by_name() -> dict[str, Query]:
    return {q.name: q for q in QUERIES}


def run(q: Query, src: Sources, as_of: date = DEFAULT_AS_OF) -> DataFrame:
    return q.build(src, as_of, **q.params)


def spark_callable(q: Query, as_of: date = DEFAULT_AS_OF) -> Callable[[SparkSession, str], DataFrame]:
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return q.build(load_fixture(spark, sf_dir, as_of), as_of, **q.params)

    fn.__name__ = q.name
    return fn


def oracle_text(q: Query, as_of: date = DEFAULT_AS_OF) -> str | None:
    return None if q.oracle is None else q.oracle(as_of, **q.params)
