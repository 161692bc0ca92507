from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField

from tidemark.operators.decode import stamp
from tidemark.operators.revenue import latency_quantiles
from tidemark.session import settings
from tidemark.streaming import sink
from tidemark.streaming.sink import store_micro_batch
from tidemark.tables.event_table import (
    TableSpec,
    add_columns,
    as_of_batch,
    as_of_time,
    batch_list,
    create_table,
    read_table,
    store_batch,
)
from tidemark.tables import upkeep
from tidemark.tables.upkeep import close_days, closed_before, drop_closed, history_view

DAY = datetime(2024, 3, 1, 12)
MODE = "spark.sql.sources.partitionOverwriteMode"


def rows(spark, start, end, at=DAY):
    data = spark.range(start, end).select(
        F.concat(F.lit("e"), F.col("id")).alias("event_id"), F.col("id").alias("n")
    )
    return stamp(data, at)


def store(spark, spec, frame, batch_id, stream="s"):
    return store_batch(spark, spec, frame, stream, batch_id)


def count(spark, spec):
    return spark.table(spec.name).count()


def test_create_append_replace(spark, table):
    spec = TableSpec(table)
    store(spark, spec, rows(spark, 0, 10), 0)
    store(spark, spec, rows(spark, 10, 30), 1)
    assert count(spark, spec) == 30
    store(spark, spec, rows(spark, 10, 30), 1)
    assert count(spark, spec) == 30
    assert spark.table(table).columns == [
        "event_id", "n", "ingestion_timestamp", "ingestion_date", "_stream", "_batch_id",
    ]
    assert read_table(spark, table).columns[-1] == "ingestion_date"


def test_failed_rewrite_keeps_the_stored_batch(spark, table):
    def fail(batches):
        yield next(batches)
        raise RuntimeError("lost")

    spec, stored = TableSpec(table), rows(spark, 0, 10)
    store(spark, spec, stored, 0)
    broken = stored.mapInArrow(fail, stored.schema)
    with pytest.raises(Exception, match="lost"):
        store(spark, spec, broken, 0)
    assert read_table(spark, table).count() == 10


def test_name_with_catalog(spark, table):
    spec = TableSpec(f"spark_catalog.{table}", evolve=True)
    store(spark, spec, rows(spark, 0, 10), 0)
    store(spark, spec, rows(spark, 10, 12).withColumn("x", F.lit(1)), 1)
    assert read_table(spark, spec.name).count() == 12


def test_batch_numbers_of_two_streams_do_not_meet(spark, table):
    spec = TableSpec(table)
    store(spark, spec, rows(spark, 0, 10), 0, "one")
    store(spark, spec, rows(spark, 50, 55), 0, "two's")
    assert count(spark, spec) == 15
    assert as_of_batch(spark, table, 0, "two's").count() == 5


def test_create_is_harmless_when_another_came_first(spark, table):
    spec = TableSpec(table)
    create_table(spark, spec, rows(spark, 0, 1).schema)
    store(spark, spec, rows(spark, 0, 4), 0)
    create_table(spark, spec, rows(spark, 0, 1).schema)
    assert count(spark, spec) == 4


@pytest.mark.parametrize("provider", ["parquet", "orc"])
def test_files_are_zstd(spark, table, provider):
    spec = TableSpec(table, provider=provider)
    store(spark, spec, rows(spark, 0, 10), 0)
    names = spark.table(table).select("_metadata.file_name").distinct().collect()
    assert names and all("zstd" in r[0] for r in names)


def test_partitions_at_a_location_survive_the_catalog(spark, table, folder):
    spec = TableSpec(table, location=f"{folder}/t")
    store(spark, spec, rows(spark, 0, 10), 0)
    spark.sql(f"DROP TABLE {table}")
    store(spark, spec, rows(spark, 10, 15), 1)
    assert count(spark, spec) == 15


def test_missing_columns_read_null_and_order_does_not_matter(spark, table):
    spec = TableSpec(table)
    store(spark, spec, rows(spark, 0, 3), 0)
    narrow = rows(spark, 3, 5).select("ingestion_date", "ingestion_timestamp", "event_id")
    store(spark, spec, narrow, 1)
    found = {r["event_id"]: r["n"] for r in spark.table(table).collect()}
    assert found == {"e0": 0, "e1": 1, "e2": 2, "e3": None, "e4": None}


def test_new_columns(spark, table):
    spec = TableSpec(table)
    store(spark, spec, rows(spark, 0, 3), 0)
    wider = rows(spark, 3, 5).withColumn("extra", F.lit(7))
    with pytest.raises(ValueError, match="extra"):
        store(spark, spec, wider, 1)
    assert count(spark, spec) == 3
    store(spark, TableSpec(table, evolve=True), wider, 1)
    found = {r["event_id"]: r["extra"] for r in spark.table(table).collect()}
    assert found == {"e0": None, "e1": None, "e2": None, "e3": 7, "e4": 7}
    add_columns(spark, table, [StructField("flag", BooleanType()), StructField("k", IntegerType())])
    assert spark.table(table).filter("flag IS NULL AND k IS NULL").count() == 5


def test_other_type_is_an_error(spark, table):
    spec = TableSpec(table, evolve=True)
    store(spark, spec, rows(spark, 0, 3), 0)
    with pytest.raises(ValueError, match="n"):
        store(spark, spec, rows(spark, 3, 5).withColumn("n", F.col("n").cast(StringType())), 1)


def three_days(spark, table):
    spec = TableSpec(table)
    for n in range(6):
        at = DAY + timedelta(days=n // 2)
        store(spark, spec, rows(spark, n * 10, n * 10 + 10, at), n)
    return spec


def partition_filters(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def test_as_of(spark, table):
    three_days(spark, table)
    assert as_of_batch(spark, table, 2).count() == 30
    assert as_of_time(spark, table, DAY + timedelta(days=1)).count() == 40
    assert as_of_time(spark, table, DAY + timedelta(days=1, seconds=-1)).count() == 20
    assert "_batch_id" in partition_filters(as_of_batch(spark, table, 2))
    assert "ingestion_date" in partition_filters(as_of_time(spark, table, DAY))


def test_loaders_side_by_side_in_one_session(spark, table):
    """Threads that write batches of one day and stream, new and again, destroy nothing."""
    spec = TableSpec(table)
    for n in range(4):
        store(spark, spec, rows(spark, n * 10, n * 10 + 10), n)
    before = {k: spark.conf.get(k, None) for k in (MODE, "spark.sql.shuffle.partitions")}
    with ThreadPoolExecutor(6) as pool:
        for _ in range(2):
            list(pool.map(lambda n: store(spark, spec, rows(spark, n * 10, n * 10 + 10), n), range(6)))
    assert sorted(r["n"] for r in spark.table(table).collect()) == list(range(60))
    assert batch_list(spark, table).count() == 6
    assert before == {k: spark.conf.get(k, None) for k in before}


def test_settings_of_threads_are_put_back_by_the_last(spark):
    name = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = spark.conf.get(name)
    outer, inner = settings(spark, {name: "false"}), settings(spark, {name: "false"})
    outer.__enter__()
    inner.__enter__()
    outer.__exit__(None, None, None)
    assert spark.conf.get(name) == "false"
    inner.__exit__(None, None, None)
    assert spark.conf.get(name) == before


def test_a_reader_keeps_the_attempt_it_reads(spark, table):
    spec = TableSpec(table)
    store(spark, spec, rows(spark, 0, 10), 0)
    reading = read_table(spark, table).toLocalIterator()
    next(reading)
    store(spark, spec, rows(spark, 0, 4), 0)
    assert len(list(reading)) == 9
    assert read_table(spark, table).count() == 4


def test_list_of_batches(spark, table):
    spec = TableSpec(table)
    timed = rows(spark, 0, 10).withColumn("event_timestamp", F.lit(DAY - timedelta(seconds=2)))
    store(spark, spec, timed, 0)
    store(spark, spec, timed.filter("n < 3"), 1, "other's")
    store(spark, spec, timed.filter("n < 5"), 0)
    assert store(spark, spec, timed.limit(0), 2) is None
    listed = batch_list(spark, table).orderBy("stored").collect()
    assert [(r["stream"], r["batch_id"], r["stored"]) for r in listed] == [("other's", 1, 3), ("s", 0, 5)]
    assert all(r["ingestion_date"] == DAY.date() for r in listed)
    found = latency_quantiles(batch_list(spark, table)).first()
    assert (found["p50_ms"], found["p95_ms"]) == (2000, 2000)
    with pytest.raises(ValueError, match="several streams"):
        as_of_batch(spark, table, 0)


def test_quantiles_without_event_time(spark, table):
    store(spark, TableSpec(table), rows(spark, 0, 10), 0)
    assert tuple(latency_quantiles(batch_list(spark, table)).first()) == (None, None)


def test_closed_days(spark, table):
    three_days(spark, table)
    closed, view = f"{table}_closed", f"{table}_all"
    with pytest.raises(Exception):
        history_view(spark, table, closed, view)
    close_days(spark, table, closed, date(2024, 3, 2))
    history_view(spark, table, closed, view)
    before = spark.table(table).collect()
    assert sorted(spark.table(view).collect()) == sorted(before)
    close_days(spark, table, closed, date(2024, 3, 3))
    close_days(spark, table, closed, date(2024, 3, 3))
    history_view(spark, table, closed, view)
    assert closed_before(spark, closed) == date(2024, 3, 3)
    assert sorted(spark.table(view).collect()) == sorted(before)
    assert as_of_batch(spark, view, 2).count() == 30
    drop_closed(spark, table, closed)
    assert spark.table(table).count() == 20
    assert sorted(spark.table(view).collect()) == sorted(before)
    files = spark.table(closed).select("_metadata.file_path").distinct().count()
    assert files == 2


def test_a_task_closes_a_bounded_part_of_the_days(spark, table, monkeypatch):
    """What a task sorts does not grow with what is closed."""
    monkeypatch.setattr(upkeep, "TASK_BYTES", 100_000)
    at = datetime(2024, 3, 1, 6)
    ids = spark.range(0, 40_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("event_id"))
    for batch in range(2):
        store_batch(spark, TableSpec(table), stamp(ids, at), "s", batch)
    closed = f"{table}_closed"
    close_days(spark, table, closed, date(2024, 3, 2))
    files = spark.table(closed).groupBy("_metadata.file_path").count().collect()
    assert sum(f["count"] for f in files) == 80_000
    assert len(files) > 4 and max(f["count"] for f in files) < 20_000


def test_a_task_stores_a_bounded_part_of_a_batch(spark, table, monkeypatch):
    """What a task folds and writes does not grow with the batch."""
    monkeypatch.setattr(sink, "TASK_BYTES", 1024**2)
    text = F.sha2(F.col("id").cast("string"), 256)
    rows = spark.range(0, 200_000, 1, 4).select(text.alias("event_id"))
    report = store_micro_batch(TableSpec(table), stamp(rows, datetime(2024, 3, 1)), "s", 0)
    assert report.stored == 200_000
    files = spark.table(table).groupBy("_metadata.file_path").count().collect()
    assert len(files) > 4 and max(f["count"] for f in files) < 50_000


def test_closed_days_take_new_columns(spark, table):
    spec = three_days(spark, table)
    closed, view = f"{table}_closed", f"{table}_all"
    close_days(spark, table, closed, date(2024, 3, 2))
    add_columns(spark, spec.name, [StructField("extra", StringType())])
    close_days(spark, table, closed, date(2024, 3, 3))
    history_view(spark, table, closed, view)
    assert spark.table(view).columns == spark.table(table).columns
    assert spark.table(view).count() == 60


def test_late_rows_of_a_closed_day(spark, table):
    """Batches that come after their day was closed are added to it, and never dropped."""
    spec = three_days(spark, table)
    closed, view = f"{table}_closed", f"{table}_all"
    close_days(spark, table, closed, date(2024, 3, 2))
    drop_closed(spark, table, closed)
    store(spark, spec, rows(spark, 100, 105, DAY), 9)
    drop_closed(spark, table, closed)
    assert spark.table(table).count() == 45
    for _ in range(2):
        close_days(spark, table, closed, date(2024, 3, 2))
        history_view(spark, table, closed, view)
        assert spark.table(view).count() == 65
    drop_closed(spark, table, closed)
    assert spark.table(table).count() == 40
    assert spark.table(view).count() == 65


def test_replay_of_a_closed_batch(spark, table):
    """A batch that was run again with other rows takes the place of its closed rows."""
    spec = three_days(spark, table)
    closed, view = f"{table}_closed", f"{table}_all"
    close_days(spark, table, closed, date(2024, 3, 2))
    store(spark, spec, rows(spark, 0, 7, DAY), 0)
    close_days(spark, table, closed, date(2024, 3, 2))
    history_view(spark, table, closed, view)
    assert spark.table(view).count() == 57


def test_batch_of_two_days_is_an_error(spark, table):
    spec = TableSpec(table)
    mixed = rows(spark, 0, 3, DAY).union(rows(spark, 3, 5, DAY + timedelta(days=1)))
    with pytest.raises(Exception, match="ingest date"):
        store(spark, spec, mixed, 0)
    store(spark, spec, rows(spark, 0, 3, DAY), 0)
    assert spark.table(table).count() == 3
