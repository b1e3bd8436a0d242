"""Jobs that the components and the Jaccard join start: each leaves buffers, plans and threads in the driver's memory."""

from __future__ import annotations

import uuid

from careledger.llm import common, jaccard


def jobs_of(spark, work):
    """Result of ``work()`` and the number of Spark jobs it started."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "test")
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_settled_edges_take_one_round(spark):
    edges = spark.createDataFrame([(i, 0) for i in range(1, 200)] + [(7, 7), (None, 3)], "a long, b long")
    comp, jobs = jobs_of(spark, lambda: common.components(edges))
    assert sorted(map(tuple, comp.collect())) == [(i, 0) for i in range(200)]
    assert jobs <= 12


def test_components_of_a_path_and_of_no_edges(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(i + 1, i) for i in range(9)] + [(50, 49)], "a long, b long")
    want = [(i, 0) for i in range(31)] + [(49, 49), (50, 49)]
    assert sorted(map(tuple, common.components(edges).collect())) == want
    assert common.components(edges.where("a < 0")).count() == 0


def test_copies_join_in_few_jobs(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[:40] + ([f"x{i}"] if i % 3 else []))) for i in range(12)]
    rows += [(20 + i, " ".join(f"t{i}_{k}" for k in range(30))) for i in range(5)] + [(40, ""), (41, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out, jobs = jobs_of(spark, lambda: jaccard.jaccard_join(docs))
    assert {r.doc_id: r.component_id for r in out.collect()} == {i: 0 if i < 12 else i for i, _ in rows}
    assert jobs <= 70
