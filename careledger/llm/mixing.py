"""Operator 6: mixing sources to target weights by systematic sampling.

Every source has a target; each of its documents is expected ``target / source size``
times. Expected copies are prefix-summed within the source in integers (units of
2**-24 copy), one offset drawn from the seed is added, and a document is emitted once per
whole number that its stretch of the sum crosses. Inside a source the documents stand by
classes of similar size, and by a seeded hash in a class, so every class is sampled in
proportion and the words taken come near the target.

The prefix sum has two levels: within a cell (source, size class, leading bits of the
hash), then over the table of cells, at most ``CELLS`` for each class of a source. A source
with a third of all rows is thus spread over thousands of cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as c

UNIT = 1 << 24
#: Cells of a (source, size class).
CELLS = 256


def size_of(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``, null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` with mix_size and its place __key (the source, never null), __band, __spread, __cell."""
    rows = docs.withColumn("mix_size", size_of(F.col("text").cast("string")))
    rows = rows.withColumn("__spread", F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.col("text").cast("string")))
    # size classes: eight to an octave; neither class nor cell may look nullable, or a join tests them on the texts again
    band = F.coalesce(F.when(F.col("mix_size") > 0, F.floor(F.log2("mix_size") * 8).cast("int")), F.lit(-1))
    cell = F.coalesce(F.floor((F.col("__spread").cast("double") / 2.0**64 + 0.5) * CELLS).cast("int"), F.lit(0))
    key = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    return rows.withColumn("__key", key).withColumn("__band", band).withColumn("__cell", cell)


def targets(sizes: DataFrame, weights=(5, 2, 1), percent: int = 150, most: int = 2) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size): one row per source.

    Sources by code point, null last, have the weights in turn and share ``percent`` % of all sizes by
    weight; a target stops at ``most`` times its source's size, and the excess is shared by weight among the
    others until none is above. That is ``least(most * size, level * weight)``, where the level follows from
    the sources in the order in which they fill up. The windows see one row per source.
    """
    n = len(weights)
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(n)) + 1).cast("int"))
    one = sizes.withColumn("w", w).withColumn("full", F.lit(float(most)) * F.col("source_size")).withColumn("at", F.col("full") / F.col("w"))
    by = Window.orderBy("at", "w", F.col("source").isNull(), F.col("source"))
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    rest = by.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(percent / 100)
    one = one.withColumn("level", (total - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    # the first source that its level does not fill sets it for all; those of later ones, which count it as full, are lower
    level = F.max(F.when(F.col("at") >= F.col("level"), F.col("level"))).over(Window.partitionBy())
    return one.select("source", "source_size", F.when(F.col("source_size") == 0, 0.0).otherwise(
        F.least(F.col("full"), F.coalesce(level, F.lit(float("inf"))) * F.col("w"))).alias("target"))


def mix(rows: DataFrame, seed: int = 7, weights=(5, 2, 1), percent: int = 150, most: int = 2) -> DataFrame:
    """``sized`` rows (doc_id, source and others) with mix_source_size, mix_target and mix_copies.

    A null text has size 0; null sources are one source, last; a source of size 0 has target 0. Copies of a
    document are 0 to ``most``. Reruns agree, as the order depends on the rows and the seed only; rows equal in
    doc_id and text stand in for each other. Null ids come first in a tie. An empty table gives no rows.
    """
    cells = c.stored(rows.groupBy("__key", "source", "__band", "__cell").agg(F.sum("mix_size").alias("size"), F.count("*").alias("n")), "cells")
    plan = targets(cells.groupBy("source").agg(F.sum("size").alias("source_size")), weights, percent, most)
    expected = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(F.lit(0)).cast("long")
    offset = F.pmod(F.xxhash64(F.coalesce("source", F.lit("\0")), F.lit(seed)), F.lit(UNIT))
    plan = plan.select(F.col("source").alias("__s"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
                       expected.alias("__expected"), offset.alias("__offset"))
    before = Window.partitionBy("source").orderBy("__band", "__cell").rowsBetween(Window.unboundedPreceding, -1)
    base = cells.join(plan, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    base = base.withColumn("__base", F.coalesce(F.sum(F.col("n") * F.col("__expected")).over(before), F.lit(0)) + F.col("__offset"))
    cell = ["__key", "__band", "__cell"]
    base = c.stored(base.select(*cell, "mix_source_size", "mix_target", "__expected", "__base"), "base")
    # the join's keys are the window's and hold no nulls, so the rows, texts and all, are shuffled once
    place = Window.partitionBy(*cell).orderBy("__spread", "doc_id")
    out = rows.withColumn("__at", F.row_number().over(place)).join(base, cell)
    end = F.col("__base") + F.col("__at") * F.col("__expected")
    copies = F.floor(end / UNIT) - F.floor((end - F.col("__expected")) / UNIT)
    out = out.withColumn("mix_copies", copies.cast("int"))
    return out.drop("__key", "__at", "__expected", "__base", "__band", "__cell", "__spread")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, source and any others) as often as the mix takes them, with the columns of ``docs``.

    As ``mix``: null texts have size 0, null sources are one source, rows equal in doc_id and text stand in for each
    other; a source without words is not taken. Names of the other columns may be any. An empty table gives no rows.
    """
    rows = sized(c.as_row(docs, "doc_id", "text", "source"), options.get("seed", 7)).drop("text")
    out = mix(rows, **options).where("mix_copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select("row.*")


def op6_mixing_weights(spark, sf_dir):
    docs = c.columns_of(c.read_table(spark, sf_dir, "documents"), {"doc_id": "long", "text": "string", "source": "string"})
    rows = c.stored(sized(docs, 7).drop("text"), "sizes")  # the texts are read once
    return mix(rows).select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                            F.col("mix_target").alias("target"), (F.col("mix_copies") * F.col("mix_size")).alias("taken"))
