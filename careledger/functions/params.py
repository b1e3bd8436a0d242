"""Query parameters as predicate builders.

A parameter left at its "all" value yields ``None`` (no filter at all), so
nothing reaches the plan that Catalyst would have to fold away.
"""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as cfg
from .exprs import col, is_blank, is_store

CHANNELS = ("Both", "Store", "Truck")
PROFILES = ("All", "Grooming only", "Products only", "Grooming & Products")
COHORTS = ("All", "Dormant (45-90 days)", "Lost (90+ days)", "Dormant + Lost")
CLOSED_WON = ("Hide", "Show")
CROSS_SELL = ("All", "Grooming only", "Food only", "Both", "Neither")
FOOD_OPPORTUNITY = ("All", "Cross-sell food", "Resupply due", "None")
FOOD_BUYER = ("All", "Yes", "No")
PERIODS = ("Today", "Yesterday", "Past 7 days", "Past 30 days", "This month")


def _check(name: str, value, domain) -> None:
    if value not in domain:
        raise ValueError(f"{name}={value!r}; expected one of {domain}")


def where(df: DataFrame, *preds: Column | None) -> DataFrame:
    """Apply the predicates that are set."""
    for p in preds:
        if p is not None:
            df = df.filter(p)
    return df


# Channel on invoices. Truck = blank profile only.
def channel_pred(channel: str = "Both", pos_profile: str | Column = "pos_profile") -> Column | None:
    _check("channel", channel, CHANNELS)
    if channel == "Store":
        return is_store(pos_profile)
    if channel == "Truck":
        return is_blank(pos_profile)
    return None


# Channel on customers, from the has_store / has_truck flags.
def customer_channel_pred(channel: str = "Both") -> Column | None:
    _check("channel", channel, CHANNELS)
    if channel == "Store":
        return F.col("has_store") == 1
    if channel == "Truck":
        return F.col("has_truck") == 1
    return None


# Purchase profile on coalesce(flag, 0).
def profile_pred(profile: str | None = "All") -> Column | None:
    if profile is None or profile == "All":
        return None
    _check("purchase_profile", profile, PROFILES)
    g = F.coalesce(F.col("has_grooming"), F.lit(0)) == 1
    p = F.coalesce(F.col("has_products"), F.lit(0)) == 1
    return {"Grooming only": g & ~p, "Products only": ~g & p, "Grooming & Products": g & p}[profile]


# Cohort on the all-channel last grooming date. Day 45 is Dormant but not
# "Dormant + Lost" (R5).
def cohort_pred(cohort: str, as_of: date, last_grooming: str | Column = "acg_last_grooming") -> Column | None:
    _check("cohort", cohort, COHORTS)
    g = col(last_grooming)
    d45 = as_of - timedelta(days=cfg.DORMANT_DAYS)
    d90 = as_of - timedelta(days=cfg.LOST_DAYS)
    if cohort == "Dormant (45-90 days)":
        return g.between(F.lit(d90), F.lit(d45))
    if cohort == "Lost (90+ days)":
        return g < F.lit(d90)
    if cohort == "Dormant + Lost":
        return g < F.lit(d45)
    return None


# P5: hide won-back rows unless asked to show them.
def closed_won_pred(show_closed_won: str, closed_won: str | Column = "closed_won") -> Column | None:
    _check("show_closed_won", show_closed_won, CLOSED_WON)
    return None if show_closed_won == "Show" else ~col(closed_won)


# P6
def cross_sell_pred(segment: str, groom: str | Column = "acg_last_grooming",
                    food: str | Column = "last_food_date") -> Column | None:
    _check("cross_sell_segment", segment, CROSS_SELL)
    g, f = col(groom).isNotNull(), col(food).isNotNull()
    return {"All": None, "Grooming only": g & ~f, "Food only": ~g & f, "Both": g & f, "Neither": ~g & ~f}[segment]


# P7
def food_opportunity_pred(value: str, food_opportunity: str | Column = "food_opportunity") -> Column | None:
    _check("food_opportunity", value, FOOD_OPPORTUNITY)
    return None if value == "All" else col(food_opportunity) == value


# P8
def food_buyer_pred(value: str, food: str | Column = "last_food_date") -> Column | None:
    _check("food_buyer", value, FOOD_BUYER)
    return {"All": None, "Yes": col(food).isNotNull(), "No": col(food).isNull()}[value]


# Named period -> inclusive (lo, hi); unknown names mean today.
def period_bounds(period: str, as_of: date) -> tuple[date, date]:
    lo = {
        "Today": as_of,
        "Yesterday": as_of - timedelta(days=1),
        "Past 7 days": as_of - timedelta(days=6),
        "Past 30 days": as_of - timedelta(days=29),
        "This month": as_of.replace(day=1),
    }.get(period, as_of)
    hi = as_of - timedelta(days=1) if period == "Yesterday" else as_of
    return lo, hi


def month_start(d: date) -> date:
    return d.replace(day=1)


def add_months(d: date, n: int) -> date:
    m = d.month - 1 + n
    y = d.year + m // 12
    m = m % 12 + 1
    last = [31, 29 if (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)) else 28, 31, 30, 31, 30,
            31, 31, 30, 31, 30, 31][m - 1]
    return date(y, m, min(d.day, last))


def last_day(d: date) -> date:
    return add_months(month_start(d), 1) - timedelta(days=1)


_REL = re.compile(r"^past(\d+)(days|months|years)(~?)$")


# Relative date range token -> inclusive (lo, hi).
def relative_range(token: str | None, as_of: date) -> tuple[date, date] | None:
    """``pastNmonths~``: from the first day N months before the current month
    through the end of the current month (``~`` includes the current unit;
    without it the range stops before the current unit). Also ``pastNdays[~]``,
    ``pastNyears[~]`` and explicit ``YYYY-MM-DD~YYYY-MM-DD``."""
    if token is None:
        return None
    if "~" in token and token[0].isdigit():
        a, b = token.split("~", 1)
        return date.fromisoformat(a), date.fromisoformat(b)
    m = _REL.match(token)
    if not m:
        raise ValueError(f"unsupported date filter {token!r}")
    n, unit, incl = int(m.group(1)), m.group(2), bool(m.group(3))
    if unit == "days":
        return (as_of - timedelta(days=n), as_of) if incl else (as_of - timedelta(days=n), as_of - timedelta(days=1))
    months = n * (12 if unit == "years" else 1)
    start = add_months(month_start(as_of), -months)
    if unit == "years":
        start = date(as_of.year - n, 1, 1)
        return (start, date(as_of.year, 12, 31)) if incl else (start, date(as_of.year - 1, 12, 31))
    return (start, last_day(as_of)) if incl else (start, month_start(as_of) - timedelta(days=1))
