"""The dashboard's cards Q01-Q40: name, builder and what of a run they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from . import activity, customers, sales
from . import followups as fq


@dataclass(frozen=True)
class Card:
    name: str
    build: Callable[..., DataFrame]  # (src, as_of, **params)
    params: dict = field(default_factory=dict)

    @property
    def reads_items(self) -> bool:
        return self.build in _READ_ITEMS or self.on_queue

    @property
    def on_queue(self) -> bool:
        """Built on the work queue: Q24 and the KPI cards."""
        return self.build is fq.followup_queue or hasattr(self.build, "kpi")


_READ_ITEMS = {
    sales.past7_daily_sales, sales.past7_daily_sales_detail, sales.mtd_revenue, sales.mtd_groomings, sales.mtd_revenue_by_channel_category,
    sales.mtd_grooming_scorecard, sales.avg_daily_grooming_revenue, sales.avg_daily_revenue_per_grooming, sales.rolling_30d,
    fq.customer_profile_v1, fq.overdue_trend,
}

#: Q21 and Q22 open from a cell of Q20 (``customers.cohort_drill``), so a run of all cards has them without a cell: no rows.
CARDS = [
    Card("q01_channel_sales_table", sales.channel_sales_table),
    Card("q02_channel_sales_wide", sales.channel_sales_wide),
    Card("q03_channel_sales_stacked", sales.channel_sales_stacked),
    Card("q04_daily_sales_by_channel", sales.daily_sales_by_channel),
    Card("q05_past7_daily_sales", sales.past7_daily_sales),
    Card("q06_past7_daily_sales_detail", sales.past7_daily_sales_detail),
    Card("q07_mtd_revenue", sales.mtd_revenue),
    Card("q08_mtd_groomings", sales.mtd_groomings),
    Card("q09_avg_daily_revenue", sales.avg_daily_revenue),
    Card("q10_mtd_revenue_by_channel_category", sales.mtd_revenue_by_channel_category),
    Card("q11_mtd_grooming_scorecard", sales.mtd_grooming_scorecard),
    Card("q12_mtd_vs_projection", sales.mtd_vs_projection),
    Card("q13_projected_month_end_sales", sales.projected_month_end_sales),
    Card("q14_avg_daily_grooming_revenue", sales.avg_daily_grooming_revenue),
    Card("q15_avg_daily_revenue_per_grooming", sales.avg_daily_revenue_per_grooming),
    Card("q16_rolling_30d", sales.rolling_30d),
    Card("q17_monthly_new_customers", customers.monthly_new_customers),
    Card("q18_returning_customers_mtd", customers.returning_customers_mtd),
    Card("q19_monthly_retention_trend", customers.monthly_retention_trend),
    Card("q20_cohort_retention", customers.cohort_retention),
    Card("q21_cohort_cell_customers", customers.cohort_cell_customers),
    Card("q22_cohort_roster", customers.cohort_roster),
    Card("q23_customer_profile_v1", fq.customer_profile_v1),
    Card("q24_followup_queue", fq.followup_queue),
    Card("q25_kpi_due_today", fq.kpi_due_today),
    Card("q26_kpi_past_due", fq.kpi_past_due),
    Card("q27_kpi_never_called", fq.kpi_never_called),
    Card("q28_kpi_future_calls", fq.kpi_future_calls),
    Card("q29_kpi_missing_date", fq.kpi_missing_date),
    Card("q30_kpi_food_cross_sell", fq.kpi_food_cross_sell),
    Card("q31_kpi_food_resupply", fq.kpi_food_resupply),
    Card("q32_kpi_total_in_queue", fq.kpi_total_in_queue),
    Card("q33_overdue_followups", fq.overdue_followups),
    Card("q34_overdue_trend", fq.overdue_trend),
    Card("q35_agent_activity", activity.agent_activity),
    Card("q36_followups_mtd_by_agent", activity.followups_mtd_by_agent),
    Card("q37_followups_mtd_total", activity.followups_mtd_total),
    Card("q38_followups_done_on_day", activity.followups_done_on_day),
    Card("q39_followups_avg_daily", activity.followups_avg_daily),
    Card("q40_followups_on_day_log", activity.followups_on_day_log),
]
