"""Interval sweep-line over a bounded date spine (J7, J9 rewritten).

``sweep_count`` counts, for every spine day, how many half-open intervals
[lo, hi) cover it: each interval becomes a +1 at its (clipped) start and a -1
at its end, the deltas are summed per day (a partial aggregation, one shuffle
of two small rows per interval), and a running sum over the spine gives the
count. Only the per-day deltas — at most one row per spine day — reach the
single ordered window, so no step grows with row count or key skew, and there
is no interval × day blow-up.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import sql_lit, sql_name
from ..sources.calendar import spine


def sweep_count(spark: SparkSession, intervals: DataFrame, start: date, end: date,
                lo: str = "lo", hi: str = "hi", date_col: str = "date", out: str = "count") -> DataFrame:
    """Spine [start, end] with the number of intervals [lo, hi) covering each day."""
    s, e = sql_lit(start), sql_lit(end)
    iv = intervals.selectExpr(f"greatest({sql_name(lo)}, {s}) AS lo", f"{sql_name(hi)} AS hi") \
        .filter(f"lo < hi AND lo <= {e}")
    deltas = (
        iv.selectExpr("lo AS d", "1 AS delta")
        .unionByName(iv.filter(f"hi <= {e}").selectExpr("hi AS d", "-1 AS delta"))
        .groupBy("d").agg(F.sum("delta").alias("delta"))
    )
    days = spine(spark, start, end, date_col)
    dc = sql_name(date_col)
    return days.join(F.broadcast(deltas), days[date_col] == deltas["d"], "left").selectExpr(
        dc, f"CAST(sum(coalesce(delta, 0)) OVER (ORDER BY {dc} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
            f"AS BIGINT) AS {sql_name(out)}")


def visit_intervals(visits: DataFrame, key: str, day: str, width: int) -> DataFrame:
    """Turn distinct (key, day) visits into disjoint intervals covering
    [day, day + width) per key: ``[day, least(day + width, next_day))``.

    The window is partitioned by key but sees one row per distinct day of that
    key, so its size is bounded by the length of the date range, not by the
    number of rows of a hot key.
    """
    k, d = sql_name(key), sql_name(day)
    nxt = f"lead({d}) OVER (PARTITION BY {k} ORDER BY {d})"
    far = f"date_add({d}, {int(width)})"
    return visits.select(key, day).distinct().selectExpr(
        k, f"{d} AS lo", f"CASE WHEN {nxt} IS NULL THEN {far} ELSE least({far}, {nxt}) END AS hi")


def rolling_distinct(spark: SparkSession, visits: DataFrame, key: str, day: str, start: date, end: date,
                     window_days: int, date_col: str = "date", out: str = "count") -> DataFrame:
    """Distinct keys with a visit in [d - window_days, d] for each d in [start, end]."""
    lo_needed = start - timedelta(days=window_days)
    v = visits.filter(f"{sql_name(day)} BETWEEN {sql_lit(lo_needed)} AND {sql_lit(end)}")
    return sweep_count(spark, visit_intervals(v, key, day, window_days + 1), start, end,
                       date_col=date_col, out=out)
