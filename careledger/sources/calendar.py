"""Date spines (S8) and literal relations.

Spines are bounded by the requested day range (at most a few hundred rows),
so joining them to aggregated facts never grows with the data.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spine(spark: SparkSession, start: date, end: date, name: str = "date") -> DataFrame:
    """One row per day in [start, end], gap-free."""
    n = (end - start).days + 1
    if n <= 0:
        raise ValueError(f"empty spine {start}..{end}")
    return spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def spine_numbered(spark: SparkSession, start: date, end: date, name: str = "date",
                   num: str = "day_num") -> DataFrame:
    """Spine with a 1-based day number."""
    n = (end - start).days + 1
    return spark.range(n).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias(name),
        (F.col("id") + 1).cast("int").alias(num),
    )


def spine_grid(spark: SparkSession, start: date, end: date, rows: list[tuple], columns: list[str],
               name: str = "date") -> DataFrame:
    """Spine × a literal dimension (channels, segments), built by exploding
    the literal rows on each day: no join, (days × rows) output rows."""
    structs = [F.struct(*[F.lit(v).alias(c) for v, c in zip(r, columns)]) for r in rows]
    return spine(spark, start, end, name).select(name, F.explode(F.array(*structs)).alias("_d")) \
        .select(name, *[F.col(f"_d.{c}").alias(c) for c in columns])

