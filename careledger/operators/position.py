"""The order of a result as data (O1-O5): each row's place, counted without bringing the rows into one task.

The rows are range-sorted and written once with the number of their partition and their place in it; what is counted on
top is one row a partition. Reading the written rows, a second pass cannot meet another split than the first.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Bits of monotonically_increasing_id that count the rows of a partition.
_ROW_BITS = 33


def with_position(df: DataFrame, order: list[Column], name: str = "Position", drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the place (from 1) of each row in ``order``, which must be total for a defined result; ``drop`` names
    columns that only the order needs."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"ordered_{uuid.uuid4().hex}")
    sorted_rows = df.orderBy(*order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}).drop(*drop)
    sorted_rows.write.parquet(path)
    rows = spark.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))  # a row a partition
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return rows.join(F.broadcast(starts), "_part").withColumn(name, place).drop("_part", "_at", "_start")


def in_order(df: DataFrame, order: list[Column], position: bool, drop: tuple[str, ...] = ()) -> DataFrame:
    """A sorted result, or (``position``) its rows with their places."""
    return with_position(df, order, drop=drop) if position else df.orderBy(*order).drop(*drop)
