"""Result shaping: spine fill (J4/J5) and fixed-value pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_spine(grid: DataFrame, facts: DataFrame, keys: list[str], values: dict[str, Column | float | int]) -> DataFrame:
    """Left-join aggregated facts onto a bounded grid and zero-fill.

    ``grid`` is a spine (× a literal dimension), at most a few hundred rows, so
    it is broadcast; ``facts`` is already aggregated to the grid's keys.
    """
    joined = facts.join(F.broadcast(grid), keys, "right")
    fills = [F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v)).alias(c) for c, v in values.items()]
    return joined.select(*keys, *fills)


def pivot_fixed(df: DataFrame, row_keys: list[str], pivot_col: str, values: list, value: Column,
                names: list[str] | None = None, agg=F.max) -> DataFrame:
    """One column per fixed pivot value: ``agg(CASE WHEN pivot = v THEN value END)``.

    Explicit values mean no extra job to discover them and a stable schema.
    """
    names = names or [str(v) for v in values]
    cols = [agg(F.when(F.col(pivot_col) == F.lit(v), value)).alias(n) for v, n in zip(values, names)]
    return df.groupBy(*row_keys).agg(*cols)

