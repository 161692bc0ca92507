"""Every registered query gives the rows of its check SQL."""

from threading import Barrier

import pytest
from compare import differences
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from tidemark.plans import inputs
from tidemark.plans import catalog
from tidemark.plans.catalog import QUERIES
from tidemark.plans.views import N_DELIVERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_check_sql():
    assert set(QUERIES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query(spark, name):
    frame = entry_point.queries()[name](spark, SF_DIR)
    assert differences(frame, SF_DIR, entry_point.oracle_sql()[name]) == ""


def test_deliveries_are_dealt_to_all_cores(spark, tmp_path):
    """A few days of a file that is sorted by time are not the work of one task."""
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    events.coalesce(1).sortWithinPartitions("ts").write.parquet(f"{tmp_path}/events.parquet")
    rows = inputs.delivery_rows(spark, str(tmp_path), 1)
    tasks = rows.groupBy(F.spark_partition_id()).count().collect()
    whole = inputs.deliveries(spark, str(tmp_path)).filter("batch_id = 1").drop("batch_id")
    assert sum(t["count"] for t in tasks) == whole.count()
    assert max(t["count"] for t in tasks) < whole.count() / spark.sparkContext.defaultParallelism
    assert rows.exceptAll(whole).isEmpty()


def test_files_of_a_delivery_are_read_together(spark, monkeypatch):
    """A delivery of a backlog is no file of one task."""
    jobs = []
    run = catalog.run_ingest
    monkeypatch.setattr(catalog, "run_ingest", lambda s, job: jobs.append(job) or run(s, job))
    found = QUERIES["stream_options"](spark, "/root/testdata/sf0.01").collect()
    assert len(found) == N_DELIVERIES
    files = spark.read.parquet(jobs[0].source.path).inputFiles()
    assert len(files) == N_DELIVERIES * int(jobs[0].source.options["maxFilesPerTrigger"]) > N_DELIVERIES


def test_feeds_are_dealt_and_landed_side_by_side(spark, tmp_path, monkeypatch):
    """No feed is encoded by the few tasks that its file gives, nor waits for another."""
    tables = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
    for name, time in tables.items():
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        rows.coalesce(1).sortWithinPartitions(time).write.parquet(f"{tmp_path}/{name}.parquet")
    together, tasks = Barrier(3), []
    run = catalog.deliver

    def deliver(records, path, shards):
        together.wait(60)
        tasks.append(records.select(F.spark_partition_id()).distinct().count())
        return run(records, path, shards)

    monkeypatch.setattr(catalog, "deliver", deliver)
    found = QUERIES["three_feeds"](spark, str(tmp_path))
    assert differences(found, "/root/testdata/sf0.001", entry_point.oracle_sql()["three_feeds"]) == ""
    assert min(tasks) >= spark.sparkContext.defaultParallelism


def _tasks_of_loads(spark, tmp_path, monkeypatch, name):
    """How many tasks hold the rows of each large delivery that a query loads."""
    rows = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    rows.coalesce(1).sortWithinPartitions("ts").write.parquet(f"{tmp_path}/events.parquet")
    tasks = []
    run = catalog.load_batch

    def load(records, *rest):
        tasks.append(records.select(F.spark_partition_id()).distinct().count())
        return run(records, *rest)

    monkeypatch.setattr(catalog, "load_batch", load)
    found = QUERIES[name](spark, str(tmp_path))
    assert differences(found, "/root/testdata/sf0.01", entry_point.oracle_sql()[name]) == ""
    assert len(tasks) == N_DELIVERIES
    # The last delivery holds late copies alone.
    return tasks[:-1]


def test_batch_reports_loads_with_all_cores(spark, tmp_path, monkeypatch):
    tasks = _tasks_of_loads(spark, tmp_path, monkeypatch, "batch_reports")
    assert min(tasks) >= spark.sparkContext.defaultParallelism


def test_ingest_columns_loads_with_all_cores(spark, tmp_path, monkeypatch):
    tasks = _tasks_of_loads(spark, tmp_path, monkeypatch, "ingest_columns")
    assert min(tasks) >= spark.sparkContext.defaultParallelism


def test_entry(spark):
    rows = {r["subscription_tier"]: r["n_events"] for r in entry_point.entry(spark).collect()}
    assert set(rows) == {"basic", "standard", "premium", "basic_ads"}
    assert sum(rows.values()) == 900
