"""Rows dated after ``as_of`` never show, and named things that are missing are errors."""

from __future__ import annotations

import tempfile
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from careledger.plans import registry
from careledger.session import checkpoint_dir
from careledger.sources.agents import agents_frame, load_agents
from careledger.sources.tables import TABLES, read_tables, write_bucketed, write_tables
from careledger.streaming.publish import publish, read_published

EARLIER = date(2001, 1, 15)


@pytest.fixture(scope="module")
def uncut_and_cut(spark, fixture_tables):
    """The fixture's rows with later ones, and the same cut at EARLIER beforehand."""
    src = fixture_tables
    later = replace(
        src, sales_invoice=src.sales_invoice.filter(F.col("posting_date") <= F.lit(EARLIER)),
        customer_follow_up=src.customer_follow_up.filter(F.col("creation") < F.lit(datetime(2001, 1, 16)).cast("timestamp_ntz")),
        call_log=src.call_log.filter(F.col("start_time") < F.lit(datetime(2001, 1, 16)).cast("timestamp_ntz")))
    return src, later


@pytest.mark.parametrize("name", [q.name for q in registry.QUERIES])
def test_later_rows_do_not_show(uncut_and_cut, name):
    uncut, cut = uncut_and_cut
    q = registry.by_name()[name]
    assert sorted(map(str, registry.run(q, uncut, EARLIER).collect())) == sorted(map(str, registry.run(q, cut, EARLIER).collect()))


def test_a_named_agent_file_must_be_there(tmp_path, monkeypatch):
    with pytest.raises(FileNotFoundError):
        load_agents(tmp_path / "none.json")
    monkeypatch.setenv("CARELEDGER_AGENTS_FILE", str(tmp_path / "none.json"))
    with pytest.raises(FileNotFoundError):
        load_agents()
    (tmp_path / "a.json").write_text('{"agents": [{"name": "x"}]}')
    with pytest.raises(ValueError):
        load_agents(tmp_path / "a.json")


def test_agent_list_follows_the_frame(spark, fixture_tables):
    root = tempfile.mkdtemp(prefix="careledger-agents-")
    write_tables(fixture_tables, root)
    own = [{"ordinal": 1, "name": "Zed", "email": "zed@example.com", "phone": None}]
    assert read_tables(spark, root, agents=agents_frame(spark, own)).agent_list == own


def test_publishing_an_empty_result_empties_its_day(spark):
    root = tempfile.mkdtemp(prefix="careledger-pub-")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    publish(df, "t", date(2001, 7, 19), root)
    publish(df, "t", date(2001, 7, 20), root)
    publish(df.where("x > 5"), "t", date(2001, 7, 20), root)
    assert sorted((str(r["as_of"]), r["x"]) for r in read_published(spark, f"{root}/t").collect()) == [("2001-07-19", 1), ("2001-07-19", 2)]


def test_checkpoint_folder_must_be_set_off_a_local_master():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        checkpoint_dir(Session())


def test_bucketed_tables_have_one_file_a_bucket(spark, fixture_tables):
    root = tempfile.mkdtemp(prefix="careledger-buckets-")
    write_bucketed(spark, fixture_tables, root, 4, "bucket_test")
    try:
        assert len(spark.table("bucket_test.sales_invoice").inputFiles()) <= 4
        assert spark.table("bucket_test.sales_invoice_item").count() == fixture_tables.sales_invoice_item.count()
    finally:
        for t in TABLES:
            spark.sql(f"DROP TABLE bucket_test.{t}")
        spark.sql("DROP DATABASE bucket_test")


@pytest.mark.parametrize("name", ["q19_monthly_retention_trend", "q20_cohort_retention"])
def test_retention_reads_the_invoices_once(fixture_tables, name):
    plan = registry.run(registry.by_name()[name], fixture_tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan parquet") == 1
