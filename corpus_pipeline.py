"""Corpus pipeline: the documents from raw table to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careledger.llm import common, jaccard, mixing, packing, quality, substring


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from the labels beside them, does not reject.

    All stay where it cannot be learnt (no labels, or of one kind only). Null and empty texts are judged like others,
    repeated rows alike. An empty table stays empty.
    """
    return quality.accepted(docs, common.read_table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of the smallest doc_id.

    What goes is chosen by doc_id and the set of shingles together, so rows of one doc_id and different texts are judged
    each by its own text, and of equal sets under one doc_id one row stays. Texts without words and rows of a null doc_id
    all stay. An empty table stays empty.
    """
    rows = jaccard.jaccard_join(docs)
    sets = rows.where("component is not null and doc_id is not null").groupBy("component", "doc_id", "node").agg(F.count("*").alias("n"))
    first = sets.groupBy("component").agg(F.min(F.struct("doc_id", "node")).alias("first"))
    sets = sets.join(first, "component").withColumn("stays", F.struct("doc_id", "node") == F.col("first"))
    ids = sets.groupBy("doc_id").agg(F.count_if("stays").alias("stay"), F.count_if(~F.col("stays")).alias("go"), F.max(F.when(F.col("stays"), F.col("n"))).alias("most"))
    ids = ids.join(rows.where("node is null").groupBy("doc_id").agg(F.count("*").alias("blank")), "doc_id", "left")
    by_row = (F.col("most") > 1) | (F.col("stay") > 0) & (F.col("go") > 0) | F.col("blank").isNotNull()
    ids = common.stored(ids.withColumn("by_row", F.coalesce(by_row, F.lit(False))).where("go > 0 or by_row"), "ids")
    out = docs.join(ids.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    if not ids.where("by_row").isEmpty():  # only where a doc_id is repeated
        mixed = jaccard.with_node(docs.join(ids.where("by_row").select("doc_id"), "doc_id", "left_semi").select(*docs.columns))
        blank = mixed.where("node is null").select("row.*")
        kept = sets.where("stays").select(F.col("doc_id").alias("id"), "node")
        own = mixed.withColumn("id", F.col("row.doc_id")).join(kept, ["id", "node"], "left_semi")
        out = out.union(own.groupBy("id", "node").agg(F.first("row").alias("row")).select("row.*")).union(blank)
    return out


def no_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents rid of the passages that an earlier one has; every row stays, null texts null, wholly repeated ones empty.

    A null doc_id comes first, rows of one doc_id lose nothing to each other. An empty table stays empty.
    """
    own = {"doc_id", "text", "n_chars"}
    plain = docs.toDF(*[n if n in own else f"column_{k}" for k, n in enumerate(docs.columns)])
    out = substring.substring_dedup(plain)
    return out.select(*plain.columns).toDF(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them (not at all, once, or twice).

    Null sources are one source, null texts have no words; rows equal in doc_id and text stand in for each other. An
    empty table stays empty.
    """
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences; a null or empty text is its end id alone, repeated rows are
    packed each. An empty table gives no pieces."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("jaccard_join", one_of_each_group),
    ("substring_dedup", no_repeated_passages),
    ("mixing", mixed),
    ("packing", packed),
]

#: Chunking, sampling by hash and tokenizing are not SQL; a test holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.workers_import(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
