"""Publishing results (K1), running a whole dashboard (K2) and refreshing it
when new source data lands (the re-aim of the cards' cache TTL).

The reference keeps no data of its own: each card is re-queried on view and
cached for a while (300 s for the day's follow-up log, 3600 s for the overdue
trend). Here a result is kept per ``as_of``. Its files are written beside the
published ones and take their place by the commit of a small manifest, which
readers follow (``read_published``): a run that fails half way leaves the old
result, and a reader never meets half of a new one.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.summary import with_summary
from ..plans.cards import CARDS, Card
from ..plans.followups import follow_up_queue, kpi_counts, queue_facts_of_all, queue_of
from ..session import checkpoint_dir
from ..sources.tables import Sources, read_tables
from . import files, state

#: Versions of a day that stay readable: the published one and the one before, for readers under way.
KEEP = 2


def publish(df: DataFrame, name: str, as_of: date, root: str) -> str:
    """K1: publish one result for ``as_of`` under ``root/name``, in place of that day's earlier one."""
    spark, path = df.sparkSession, os.path.join(root, name)
    data = f"{path}/data/as_of={as_of.isoformat()}/{uuid.uuid4().hex}"
    try:
        df.write.parquet(data)
    except BaseException:
        files.delete(spark, data)
        raise
    manifests = f"{path}/manifests/as_of={as_of.isoformat()}"
    files.commit(spark, manifests, {"data": data})
    for old in files.forget_older(spark, manifests, KEEP):
        files.delete(spark, old["data"])
    return path


def read_published(spark: SparkSession, path: str, as_of: date | None = None) -> DataFrame:
    """The published rows of a result with their ``as_of``, of one day or of all."""
    days = [n.removeprefix("as_of=") for n in files.names(spark, f"{path}/manifests")]
    days = [x for x in days if as_of is None or x == as_of.isoformat()]
    if not days:
        raise FileNotFoundError(f"nothing published under {path}" + (f" for {as_of}" if as_of else ""))
    out = None
    for day in days:
        data = files.latest(spark, f"{path}/manifests/as_of={day}")["data"]
        rows = spark.read.parquet(data).withColumn("as_of", F.lit(date.fromisoformat(day)))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def run_all(src: Sources, as_of: date, root: str, cards: Iterable[Card | str] | None = None,
            params: dict[str, dict] | None = None, facts: DataFrame | None = None) -> dict[str, str]:
    """K2: run all (or the given) cards for one ``as_of`` and publish each result. A card is given by its name or as a
    ``Card``, two of one name are an error; ``params`` overrides parameters by name.

    The cards share what they have in common, stored in the shared folder while the run lasts, so a lost executor reads it
    again: one summary of the invoices and their lines, after which no card reads items; the facts of the queue's customers
    for all channels (or the ``facts`` of ``streaming.state``); and one row with all KPI counts for each set of filters.
    """
    spark = src.sales_invoice.sparkSession
    by_name = {c.name: c for c in CARDS}
    chosen = [by_name[c] if isinstance(c, str) else c for c in (CARDS if cards is None else cards)]
    if len({c.name for c in chosen}) < len(chosen):
        raise ValueError("two cards of one name")
    todo = [(c, {**c.params, **(params or {}).get(c.name, {})}) for c in chosen]
    scratch = os.path.join(checkpoint_dir(spark), f"run_all_{uuid.uuid4().hex}")

    def stored(df: DataFrame) -> DataFrame:
        path = f"{scratch}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    src, out, bases, counts = src.at(as_of), {}, {}, {}
    try:
        queue = [p.get("channel", "Both") for c, p in todo if c.on_queue]
        if any(c.reads_items and not (c.on_queue and facts is not None) for c, _ in todo):
            src = with_summary(src, scratch)
        if queue:
            facts = stored(queue_facts_of_all(src, as_of, sorted(set(queue)))) if facts is None else facts
            bases = {ch: queue_of(facts, as_of, ch) for ch in set(queue)}
        for c, p in todo:
            if hasattr(c.build, "kpi"):
                key = tuple(sorted(p.items()))
                if key not in counts:
                    counts[key] = stored(kpi_counts(follow_up_queue(src, as_of, base=bases[p.get("channel", "Both")], **p)))
                p = {**p, "counts": counts[key]}
            elif c.on_queue:
                p = {**p, "base": bases[p.get("channel", "Both")]}
            out[c.name] = publish(c.build(src, as_of, **p), c.name, as_of, root)
    finally:
        files.delete(spark, scratch)
    return out


#: Tables whose new files start a refresh, and the column that leads to the customers they touch.
WATCHED = {"sales_invoice": "customer", "sales_invoice_item": "parent", "customer_follow_up": "customer", "call_log": None}


def refresh_on_arrival(spark: SparkSession, tables_root: str, results_root: str, as_of_fn,
                       names: Iterable[Card | str] | None = None, interval: str | None = "300 seconds",
                       available_now: bool = False):
    """Re-run the cards each time new invoices, items, follow-ups or calls land.

    The four tables are watched as parquet file streams. A micro-batch says which customers its rows touch; the work
    queue's per-customer state (``streaming.state``) is recomputed for these alone, and the cards are published for
    ``as_of_fn()``. Progress is kept under ``spark.checkpoint.dir``, so a restarted driver resumes.
    """
    own = hashlib.sha256(f"{tables_root}\n{results_root}".encode()).hexdigest()[:16]
    names = list(names) if names is not None else None
    arrivals = None
    for table, key in WATCHED.items():
        path = os.path.join(tables_root, table)
        rows = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
        rows = rows.select(F.lit(table).alias("table"), (F.col(key) if key else F.lit(None)).cast("string").alias("key"))
        arrivals = rows if arrivals is None else arrivals.union(rows)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        src, as_of = read_tables(spark, tables_root), as_of_fn()
        of_items = batch.filter("table = 'sales_invoice_item'").select(F.col("key").alias("name"))
        touched = batch.filter("table IN ('sales_invoice', 'customer_follow_up')").select(F.col("key").alias("customer")) \
            .union(src.sales_invoice.join(of_items, "name", "left_semi").select("customer"))
        facts = state.refreshed(src, as_of, os.path.join(results_root, "customer_state"), touched)
        run_all(src, as_of, results_root, names, facts=facts)

    writer = arrivals.writeStream.foreachBatch(on_batch).option("checkpointLocation", os.path.join(checkpoint_dir(spark), f"refresh_{own}"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()
