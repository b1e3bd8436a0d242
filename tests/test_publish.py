"""K1 / K2 and the streaming refresh."""

from __future__ import annotations

import os
import re
import subprocess
import sys
import tempfile
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest

from builders import fu, inv, item, sources
from conftest import ROOT

from careledger.config import DEFAULT_AS_OF
from careledger.plans import registry
from careledger.plans.cards import CARDS, Card
from careledger.plans import sales
from careledger.session import checkpoint_dir
from careledger.sources.tables import read_tables, write_tables
from careledger.streaming import files, state
from careledger.streaming.publish import publish, read_published, refresh_on_arrival, run_all

NAMES = ["q07_mtd_revenue", "q32_kpi_total_in_queue", "q36_followups_mtd_by_agent"]
QUEUE_CARDS = ["q24_followup_queue", "q24_followup_queue_truck_dormant_lost", "q26_kpi_past_due",
               "q30_kpi_food_cross_sell", "q32_kpi_total_in_queue_store_products"]


def test_publish_overwrites_only_its_day(spark, fixture_tables):
    root = tempfile.mkdtemp(prefix="careledger-pub-")
    df = spark.createDataFrame([(1,)], "x int")
    publish(df, "t", date(2001, 7, 19), root)
    publish(df, "t", date(2001, 7, 20), root)
    publish(spark.createDataFrame([(2,), (3,)], "x int"), "t", date(2001, 7, 20), root)
    rows = sorted((str(r["as_of"]), r["x"]) for r in read_published(spark, f"{root}/t").collect())
    assert rows == [("2001-07-19", 1), ("2001-07-20", 2), ("2001-07-20", 3)]


def test_run_all_publishes_each_card(spark, fixture_tables):
    root = tempfile.mkdtemp(prefix="careledger-run-")
    paths = run_all(fixture_tables, DEFAULT_AS_OF, root, NAMES)
    assert set(paths) == set(NAMES)
    total = read_published(spark, paths["q32_kpi_total_in_queue"]).collect()
    assert len(total) == 1 and total[0]["Count"] > 0


def test_refresh_on_arrival_runs_once_per_new_data(spark, fixture_tables):
    tables = tempfile.mkdtemp(prefix="careledger-tables-")
    write_tables(fixture_tables, tables)
    results = tempfile.mkdtemp(prefix="careledger-results-")
    q = refresh_on_arrival(spark, tables, results, lambda: DEFAULT_AS_OF, names=NAMES[:1], available_now=True)
    q.awaitTermination(300)
    got = read_published(spark, f"{results}/{NAMES[0]}").collect()
    assert len(got) == 1 and str(got[0]["as_of"]) == str(DEFAULT_AS_OF)


def test_run_all_shared_queue_equals_per_query(spark, fixture_tables):
    root = tempfile.mkdtemp(prefix="careledger-run-")
    by_name = registry.by_name()
    paths = run_all(fixture_tables, DEFAULT_AS_OF, root, [Card(n, by_name[n].build, by_name[n].params) for n in QUEUE_CARDS])
    for name in QUEUE_CARDS:
        direct = registry.run(by_name[name], fixture_tables)
        published = read_published(spark, paths[name]).drop("as_of")
        assert sorted(map(tuple, direct.collect()), key=str) == sorted(map(tuple, published.select(
            *direct.columns).collect()), key=str), name


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_run_of_all_cards_reads_items_once(spark, fixture_tables, monkeypatch):
    from careledger.operators import allocation, summary
    from careledger.plans import followups

    read = []
    for module in (allocation, summary, followups):
        of = module.items
        monkeypatch.setattr(module, "items", lambda *a, of=of, **k: read.append(1) or of(*a, **k))
    before = set(os.listdir(checkpoint_dir(spark)))
    root = tempfile.mkdtemp(prefix="careledger-run-")
    paths = run_all(fixture_tables, DEFAULT_AS_OF, root)
    assert len(read) == 1 and len(paths) == len(CARDS) == 40
    left = {n for n in set(os.listdir(checkpoint_dir(spark))) - before if n.startswith("run_all")}
    assert not left  # what the cards shared is gone
    by_name = registry.by_name()
    for name in ("q05_past7_daily_sales", "q11_mtd_grooming_scorecard", "q16_rolling_30d", "q23_customer_profile_v1", "q24_followup_queue",
                 "q31_kpi_food_resupply", "q34_overdue_trend"):
        assert rows(read_published(spark, paths[name]).drop("as_of")) == rows(registry.run(by_name[name], fixture_tables)), name


def test_two_cards_of_one_name_are_an_error(fixture_tables, tmp_path):
    with pytest.raises(ValueError):
        run_all(fixture_tables, DEFAULT_AS_OF, str(tmp_path), ["q37_followups_mtd_total"] * 2)


def test_cards_need_no_oracle_and_no_fixtures():
    code = ("import sys; import careledger.streaming.publish; "
            "sys.exit(any(m.startswith(('careledger.oracle', 'careledger.sources.fixtures')) for m in sys.modules))")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)


def test_a_write_that_fails_leaves_the_old_day(spark, tmp_path):
    root, day = str(tmp_path), date(2001, 7, 20)
    publish(spark.range(5), "t", day, root)
    broken = spark.range(0, 1000, 1, 8).selectExpr("CASE WHEN id = 990 THEN raise_error('lost') ELSE id END AS id")
    with pytest.raises(Exception, match="lost"):
        publish(broken, "t", day, root)
    assert read_published(spark, f"{root}/t", day).count() == 5
    draft = tmp_path / "t" / "manifests" / "as_of=2001-07-20" / ".draft-x"
    draft.write_text("{")  # a writer that died before its commit
    assert read_published(spark, f"{root}/t", day).count() == 5
    for n in (6, 7, 8):
        publish(spark.range(n), "t", day, root)
    assert read_published(spark, f"{root}/t", day).count() == 8
    assert len(os.listdir(tmp_path / "t" / "data" / "as_of=2001-07-20")) == 2  # the published version and the one before


def landed(spark, src, customer):
    """New rows of one customer: an invoice of yesterday with a line, and a follow-up."""
    day = DEFAULT_AS_OF - timedelta(days=1)
    new = sources(spark, [inv("NEW1", customer, day, 110, 100)], [item("NEW1", 100)],
                  follow_ups=[fu("ZZNEW", customer, datetime(2001, 7, 19, 12), DEFAULT_AS_OF)])
    return replace(new, customer=src.customer.limit(0), call_log=src.call_log.limit(0))


def test_new_rows_refresh_their_customers_only(spark, fixture_tables):
    tables, results = tempfile.mkdtemp(prefix="careledger-tables-"), tempfile.mkdtemp(prefix="careledger-results-")
    write_tables(fixture_tables, tables)
    names = ["q24_followup_queue", "q25_kpi_due_today", "q32_kpi_total_in_queue"]

    def refresh():
        refresh_on_arrival(spark, tables, results, lambda: DEFAULT_AS_OF, names=names, available_now=True).awaitTermination(600)
        return files.latest(spark, f"{results}/customer_state/manifests")["buckets"]

    before = refresh()
    customer = fixture_tables.customer_follow_up.join(fixture_tables.customer, fixture_tables.customer_follow_up.customer == fixture_tables.customer.name) \
        .agg({"customer": "max"}).first()[0]
    write_tables(landed(spark, fixture_tables, customer), tables, mode="append")
    after = refresh()
    moved = {b for b in after if after[b] != before.get(b)}
    assert len(moved) == 1
    src = read_tables(spark, tables)
    by_name = registry.by_name()
    for name in names:
        full = registry.run(by_name[name], src)
        assert rows(read_published(spark, f"{results}/{name}").select(*full.columns)) == rows(full), name
    called = [r for r in read_published(spark, f"{results}/q24_followup_queue").collect() if r["Customer ID"] == customer]
    assert called and called[0]["Follow-up Date"] == DEFAULT_AS_OF
    touched = spark.createDataFrame([(customer,)], "customer string")
    own = state.facts_of(state.narrowed(src.at(DEFAULT_AS_OF), touched), touched)
    plan = own._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = re.findall(r"FileScan parquet.*", plan)
    assert len(scans) >= 3 and all(f"EqualTo(customer,{customer})" in s or "posting_month" in s for s in scans)
    assert all("PartitionFilters: [" + "]" not in s for s in scans if "item_code" in s)


def test_a_later_day_touches_what_was_dated_ahead(spark, fixture_tables):
    root = tempfile.mkdtemp(prefix="careledger-state-")
    early, none = DEFAULT_AS_OF - timedelta(days=5), spark.createDataFrame([], "customer string")
    state.refreshed(fixture_tables, early, root, none)
    got = state.refreshed(fixture_tables, DEFAULT_AS_OF, root, none)
    want = state.facts_of(fixture_tables.at(DEFAULT_AS_OF))
    assert rows(got.select(*[f"`{c}`" for c in want.columns])) == rows(want)


def test_an_appended_day_equals_the_year_anew(spark, fixture_tables):
    root = tempfile.mkdtemp(prefix="careledger-rolling-") + "/changes"
    split = DEFAULT_AS_OF - timedelta(days=2)
    sales.write_day_changes(fixture_tables, root, DEFAULT_AS_OF - timedelta(days=420), split)
    for n in (1, 0):
        day = DEFAULT_AS_OF - timedelta(days=n)
        sales.write_day_changes(fixture_tables, root, day, day)
    assert rows(sales.rolling_30d(fixture_tables, DEFAULT_AS_OF, stored=root)) == rows(sales.rolling_30d(fixture_tables, DEFAULT_AS_OF))
