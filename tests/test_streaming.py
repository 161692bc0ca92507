import json
import logging
import time
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators.decode import EVENT_TIME, INGEST_TIME, decode
from tidemark.operators.dedup import copy_folder
from tidemark.schemas import get_schema
from tidemark.sources.stream import (
    LATEST,
    TRIM_HORIZON,
    Source,
    batch_options,
    open_stream,
    start_options,
)
from tidemark.sources.synth import payment_stream
from tidemark.sources.wire import WIRE_SCHEMA, encode
from tidemark.streaming.ingest import (
    IngestJob,
    event_rows,
    load_batch,
    run_all,
    run_ingest,
    start_ingest,
    start_rows,
    wait,
)
from tidemark.streaming.progress import ProgressLog
from tidemark.streaming.rates import late_rows, run_rates
from tidemark.streaming.sink import TableSink
from tidemark.tables.event_table import TableSpec, batch_list, current

NOON = "2024-03-01T12:00:00+00:00"


def event(name, time=NOON):
    return json.dumps({"event_id": name, "event_timestamp": time, "amount_usd": 1.0})


def land(spark, job, payloads):
    rows = [("k", p.encode()) for p in payloads]
    spark.createDataFrame(rows, WIRE_SCHEMA).coalesce(1).write.mode("append").parquet(
        job.source.path
    )


def job_for(table, folder, **more):
    values = {
        "job_name": "test",
        "source": Source(path=f"{folder}/wire"),
        "table": TableSpec(table),
        "schema_name": "subscription_payment",
        "checkpoint": f"{folder}/checkpoint",
        "start": TRIM_HORIZON,
        "trigger": {"availableNow": True},
    }
    return IngestJob(**{**values, **more})


def ids(spark, table):
    return sorted(r["event_id"] or "" for r in current(spark, table).collect())


def crash(batch_id):
    raise RuntimeError("crash")


def test_dedup_within_a_batch_only(spark, table, folder):
    job = job_for(table, folder)
    land(spark, job, [event("a"), event("a"), event("b")])
    run_ingest(spark, job)
    land(spark, job, [event("a"), event("c")])
    run_ingest(spark, job)
    assert ids(spark, table) == ["a", "a", "b", "c"]
    counts = batch_list(spark, table).select("batch_id", "received", "undecodable", "stored")
    assert sorted(map(tuple, counts.collect())) == [(0, 3, 0, 2), (1, 2, 0, 2)]


def test_undecodable_rows_fold_to_one_per_batch(spark, table, folder):
    job = job_for(table, folder)
    land(spark, job, ["x", "", "[]", event("a")])
    report = run_ingest(spark, job).sink.report
    land(spark, job, ["y", "z"])
    run_ingest(spark, job)
    assert ids(spark, table) == ["", "", "a"]
    assert (report.received, report.undecodable, report.stored) == (4, 3, 2)


def test_replay_after_a_crash_before_commit(spark, table, folder):
    job = job_for(table, folder)
    land(spark, job, [event("a"), event("b")])
    run_ingest(spark, job)
    land(spark, job, [event("c"), event("a")])
    with pytest.raises(Exception, match="crash"):
        run_ingest(spark, job, after_write=crash)

    def stamps():
        stored = current(spark, table).filter("_batch_id = 1")
        return stored.select("ingestion_timestamp").distinct().collect()

    before = stamps()
    run_ingest(spark, job)
    assert ids(spark, table) == ["a", "a", "b", "c"]
    assert stamps() == before
    run_ingest(spark, job)
    assert ids(spark, table) == ["a", "a", "b", "c"]


def test_a_crash_in_the_first_batch(spark, table, folder):
    job = job_for(table, folder)
    land(spark, job, [event("a"), event("b")])
    with pytest.raises(Exception, match="crash"):
        run_ingest(spark, job, after_write=crash)
    run_ingest(spark, job)
    assert ids(spark, table) == ["a", "b"]


def test_empty_batch_makes_no_table(spark, table, folder):
    job = job_for(table, folder)
    land(spark, job, [])
    running = run_ingest(spark, job)
    assert not spark.catalog.tableExists(table)
    assert running.sink.report is None


def test_a_backlog_is_cut_into_batches(spark, table, folder):
    limit = {"maxBytesPerTrigger": "1000"}
    job = job_for(table, folder, source=Source(path=f"{folder}/wire", options=limit))
    for n in range(3):
        land(spark, job, [event(f"e{n}")])
    running = run_ingest(spark, job)
    assert ids(spark, table) == ["e0", "e1", "e2"]
    assert running.sink.report.batch_id == 2
    assert batch_list(spark, table).count() == 3


def test_a_small_batch_is_one_file(spark, table, folder):
    job = job_for(table, folder)
    land(spark, job, [event(f"e{n}") for n in range(500)])
    run_ingest(spark, job)
    assert current(spark, table).select("_metadata.file_path").distinct().count() == 1


@pytest.mark.parametrize("trigger", [{}, {"processingTime": "1 second"}])
def test_runs_until_it_is_stopped(spark, table, folder, trigger):
    job = job_for(table, folder, trigger=trigger)
    land(spark, job, [event("a")])
    running = start_ingest(spark, job)
    try:
        land(spark, job, [event("b")])
        running.query.processAllAvailable()
        land(spark, job, [event("c")])
        running.query.processAllAvailable()
        assert running.query.isActive
    finally:
        running.query.stop()
    assert ids(spark, table) == ["a", "b", "c"]


def test_generated_stream_to_table(spark, table, folder):
    """Generator, wire records and ingest, end to end and all of them streams."""
    job = job_for(table, folder)
    sent = (
        encode(payment_stream(spark, 500))
        .writeStream.format("parquet")
        .option("path", job.source.path)
        .option("checkpointLocation", f"{folder}/sender")
        .start()
    )
    try:
        while sent.isActive and not (sent.lastProgress and sent.lastProgress.batchId >= 2):
            sent.awaitTermination(1)
    finally:
        sent.stop()
    run_ingest(spark, job)
    landed = spark.read.parquet(job.source.path).count()
    assert current(spark, table).count() == landed >= 500
    assert current(spark, table).filter("event_timestamp IS NULL").isEmpty()


def test_orc_files(spark, table, folder):
    job = job_for(table, folder, source=Source(path=f"{folder}/orc", format="orc"))
    records = [("k", event("a").encode())]
    spark.createDataFrame(records, WIRE_SCHEMA).write.orc(job.source.path)
    run_ingest(spark, job)
    assert ids(spark, table) == ["a"]


def test_text_files(spark, table, folder):
    job = job_for(table, folder, source=Source(path=f"{folder}/text", format="text"))
    lines = [(event("a"),), ("",), (event("b"),)]
    spark.createDataFrame(lines, "value STRING").coalesce(1).write.text(job.source.path)
    run_ingest(spark, job)
    assert ids(spark, table) == ["", "a", "b"]


@pytest.mark.parametrize("time_column", [INGEST_TIME, EVENT_TIME])
def test_dedup_across_batches(spark, table, folder, time_column):
    job = job_for(
        table, folder, dedup_delay="10 days", dedup_time=time_column, state_partitions=2
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    land(spark, job, [event("a"), event("a"), event("b")])
    run_ingest(spark, job)
    land(spark, job, [event("a"), event("c"), event("d", "2024-03-09T00:00:00+00:00")])
    run_ingest(spark, job)
    land(spark, job, [event("c"), event("d", "2024-03-09T00:00:00+00:00")])
    run_ingest(spark, job)
    assert ids(spark, table) == ["a", "b", "c", "d"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_dedup_across_batches_folds_a_flood(spark, table, folder):
    """Copies are folded in the map tasks, before the stateful shuffle."""
    copies = pa.RecordBatch.from_pydict({"event_id": ["a", None, "a", None, "b"], "n": range(5)})
    assert [b.to_pydict() for b in copy_folder()(iter([copies]))] == [
        {"event_id": ["a", None, "b"], "n": [0, 1, 4]}
    ]
    job = job_for(table, folder, dedup_delay="1 day", state_partitions=2)
    land(spark, job, [event("hot")] * 5000 + ["broken"] * 5000 + [event("a")])
    running = run_ingest(spark, job)
    assert ids(spark, table) == ["", "a", "hot"]
    assert running.query.recentProgress[0].stateOperators[0].numRowsTotal == 3
    assert batch_list(spark, table).agg({"received": "sum"}).first()[0] == 3


def test_no_row_is_late_by_ingest_time(spark, table, folder):
    """Old, timeless and undecodable rows are all stored, repeated ids once."""
    job = job_for(table, folder, dedup_delay="1 day", state_partitions=2)
    land(spark, job, [event("a"), event("t", "soon"), event("t", "soon"), "broken", "worse"])
    run_ingest(spark, job)
    land(spark, job, [event("old", "2020-01-01"), event("a"), event("t", "soon"), "broken"])
    run_ingest(spark, job)
    land(spark, job, [event("older", "2019-01-01"), event("old", "2020-01-01")])
    run_ingest(spark, job)
    assert ids(spark, table) == ["", "", "a", "old", "older", "t"]


def test_late_rows_by_event_time(spark, table, folder):
    job = job_for(table, folder, dedup_delay="1 day", dedup_time=EVENT_TIME, state_partitions=2)
    land(spark, job, [event("a"), event("t", "soon"), event("t", "soon"), "broken", "worse"])
    run_ingest(spark, job)
    land(spark, job, [event("late", "2020-01-01"), event("b"), "broken"])
    running = run_ingest(spark, job)
    assert ids(spark, table) == ["", "", "a", "b", "t"]
    states = [op for p in running.query.recentProgress for op in p.stateOperators]
    assert sum(op.numRowsDroppedByWatermark for op in states) > 0


def test_ids_are_compared_with_stored_ones(spark, table, folder):
    """Without state, also after a crash between write and commit; a hot id folds before."""
    job = job_for(table, folder, dedup_days=3)
    land(spark, job, [event("a"), event("a"), event("b"), "broken"])
    run_ingest(spark, job)
    land(spark, job, [event("a")] * 2000 + [event("c"), "broken"])
    with pytest.raises(Exception, match="crash"):
        run_ingest(spark, job, after_write=crash)
    assert ids(spark, table) == ["", "", "a", "b", "c"]
    run_ingest(spark, job)
    assert ids(spark, table) == ["", "", "a", "b", "c"]
    land(spark, job, [event("c"), event("b")])
    run_ingest(spark, job)
    assert ids(spark, table) == ["", "", "a", "b", "c"]


def test_ids_older_than_the_days_may_come_again(spark, table, folder):
    job = job_for(table, folder, dedup_days=2)
    records = spark.createDataFrame([("k", event("a").encode())], WIRE_SCHEMA)
    for number, day in enumerate((1, 3, 6)):
        load_batch(records, job, number, datetime(2024, 3, day))
    assert ids(spark, table) == ["a", "a"]


def test_quarantine_takes_what_does_not_decode(spark, table, folder):
    lost = TableSpec(f"{table}_lost")
    job = job_for(table, folder, quarantine=lost)
    bad = ["not json", "not json", "", "[]", '{"id":1}', '{"event_id":null}']
    land(spark, job, [event("a"), event("a"), *bad])

    def stop(batch_id):
        raise RuntimeError("between")

    sink = TableSink(job.storing, between=stop)
    with pytest.raises(Exception, match="between"):
        wait(start_rows(spark, job, event_rows(spark, job), sink))
    assert current(spark, table).count() == 0
    run_ingest(spark, job)
    land(spark, job, ["only this"])
    run_ingest(spark, job)
    land(spark, job, [event("b")])
    run_ingest(spark, job)
    assert ids(spark, table) == ["a", "b"]
    found = current(spark, lost.name).select("_batch_id", "payload", "cause", "n_records").collect()
    assert sorted(map(tuple, found)) == [
        (0, "", "empty", 1),
        (0, "[]", "no object", 1),
        (0, "not json", "not JSON", 2),
        (0, '{"event_id":null}', "no event id", 1),
        (0, '{"id":1}', "no event id", 1),
        (1, "only this", "not JSON", 1),
    ]
    listed = batch_list(spark, table).orderBy("batch_id").collect()
    counts = [(r["received"], r["undecodable"], r["stored"]) for r in listed]
    assert counts == [(8, 6, 1), (1, 1, 0), (1, 0, 1)]


def test_a_flood_of_one_payload_folds(spark, table, folder):
    job = job_for(table, folder, quarantine=TableSpec(f"{table}_lost"))
    land(spark, job, ["broken"] * 5000 + [event("a")])
    run_ingest(spark, job)
    assert current(spark, f"{table}_lost").select("n_records").collect() == [(5000,)]
    with pytest.raises(ValueError, match="dedup_delay"):
        job_for(table, folder, quarantine=TableSpec("x"), dedup_delay="1 day")


def test_rates_of_finished_minutes(spark, table, folder, caplog):
    """Copies count once, a late event is reported and left out, a replay changes nothing."""
    job = job_for(table, folder, state_partitions=2)
    listener = ProgressLog()
    spark.streams.addListener(listener)

    def typed(name, time):
        return json.dumps({"event_id": name, "event_timestamp": time, "event_type": "t"})

    try:
        land(spark, job, [typed("a", "2024-03-01T12:00:10Z"), typed("b", "2024-03-01T12:00:50Z")])
        run_rates(spark, job, "10 minutes")
        land(spark, job, [typed("a", "2024-03-01T12:00:10Z"), typed("c", "2024-03-01T13:00:00Z"), "broken"])
        run_rates(spark, job, "10 minutes")
        land(spark, job, [typed("late", "2024-03-01T12:00:20Z"), typed("d", "2024-03-01T14:00:00Z")])
        running = run_rates(spark, job, "10 minutes")
        for _ in range(50):
            if "behind the watermark" in caplog.text:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert late_rows(running) == 1
    assert "1 rows behind the watermark" in caplog.text
    rows = current(spark, table).orderBy("minute").collect()
    assert [(r["minute"].minute, r["minute"].hour, r["n_events"]) for r in rows] == [(0, 12, 2), (0, 13, 1)]


def test_a_source_that_counts(spark, table, folder):
    """Offsets of a source that is no file go on where the last run ended."""
    source = Source(format="rate-micro-batch", options={"rowsPerBatch": "10"})
    job = job_for(table, folder, source=source)
    for _ in range(3):
        ticks = open_stream(spark, source, TRIM_HORIZON, job.checkpoint)
        payload = F.format_string('{"event_id":"e%d"}', "value")
        rows = decode(ticks.select(payload.alias("data")), get_schema(job.schema_name))
        wait(start_rows(spark, job, rows, TableSink(job.storing)))
    assert ids(spark, table) == sorted(f"e{n}" for n in range(30))


def land_in(spark, job, shard, payloads):
    rows = [("k", p.encode()) for p in payloads]
    frame = spark.createDataFrame(rows, WIRE_SCHEMA).coalesce(1)
    frame.write.mode("append").parquet(f"{job.source.path}/shard={shard}")


@pytest.mark.parametrize("start", [LATEST, TRIM_HORIZON])
def test_offsets_of_shards(spark, table, folder, start):
    """Each shard goes on at its own offset, also after a crash, and new shards begin at theirs."""
    job = job_for(table, folder, source=Source(path=f"{folder}/log", format="sharded_log"), start=start)
    land_in(spark, job, 0, [event("old")])
    run_ingest(spark, job)
    land_in(spark, job, 0, [event("a"), event("b")])
    land_in(spark, job, 1, [event("c")])
    with pytest.raises(Exception, match="crash"):
        run_ingest(spark, job, after_write=crash)
    land_in(spark, job, 1, [event("d")])
    run_ingest(spark, job)
    land_in(spark, job, 0, [event("e")])
    run_ingest(spark, job)
    assert ids(spark, table) == ["a", "b", "c", "d", "e", *(["old"] if start == TRIM_HORIZON else [])]
    numbers = [r["batch_id"] for r in batch_list(spark, table).collect()]
    assert len(numbers) == len(set(numbers)) == (2 if start == LATEST else 3)


def test_latest_leaves_out_what_was_there(spark, table, folder):
    job = job_for(table, folder, start=LATEST)
    land(spark, job, [event("old")])
    time.sleep(2)
    running = run_ingest(spark, job)
    # Old files are left out by their times, not read and filtered.
    assert sum(p.numInputRows for p in running.query.recentProgress) == 0
    land(spark, job, [event("while down")])
    time.sleep(2)
    run_ingest(spark, job)
    assert ids(spark, table) == ["while down"]


def test_latest_survives_a_crash_in_the_first_batch(spark, table, folder):
    job = job_for(table, folder, start=LATEST)
    land(spark, job, [event("old")])
    time.sleep(2)
    event_rows(spark, job)
    land(spark, job, [event("new")])
    with pytest.raises(Exception, match="crash"):
        run_ingest(spark, job, after_write=crash)
    time.sleep(2)
    run_ingest(spark, job)
    assert ids(spark, table) == ["new"]


def test_start_positions(spark):
    kafka = Source(format="kafka")
    assert start_options(kafka, LATEST) == {"startingOffsets": "latest"}
    assert start_options(kafka, TRIM_HORIZON) == {"startingOffsets": "earliest"}
    assert start_options(Source(format="other"), "X") == {"startingPosition": "X"}
    assert start_options(Source(path="p"), LATEST) == {}
    assert batch_options(Source(path="p")) == {"maxBytesPerTrigger": str(2**31)}
    assert batch_options(Source(path="p", options={"maxFilesPerTrigger": "9"})) == {}
    assert batch_options(kafka) == {}
    assert (kafka.payload_column, Source().payload_column) == ("value", "data")
    with pytest.raises(ValueError, match="NEWEST.*LATEST, TRIM_HORIZON"):
        open_stream(spark, Source(path="p"), "NEWEST")


def test_two_feeds_side_by_side_and_the_first_failure_is_raised(spark, table, folder):
    jobs = [job_for(f"{table}_{n}", f"{folder}/{n}", job_name=f"feed {n}") for n in (1, 2)]
    with pytest.raises(ValueError, match="checkpoint"):
        run_all(spark, [jobs[0], jobs[0]])
    for job in jobs:
        land(spark, job, [event("a")])
    run_all(spark, jobs)
    assert ids(spark, f"{table}_1") == ids(spark, f"{table}_2") == ["a"]
    spark.sql(f"ALTER TABLE {table}_2 SET TBLPROPERTIES ('x' = 'y')")
    spark.sql(f"DROP TABLE {table}_2")
    spark.sql(f"CREATE TABLE {table}_2 (event_id INT, ingestion_date DATE) USING parquet")
    land(spark, jobs[1], [event("b")])
    with pytest.raises(Exception, match="types differ"):
        run_all(spark, jobs)
    assert not spark.streams.active


def test_retry_of_a_batch_load(spark, table, folder):
    job = job_for(table, folder)
    records = spark.createDataFrame([("k", event(n).encode()) for n in "aab"], WIRE_SCHEMA)
    for _ in range(2):
        report = load_batch(records, job, 7, datetime(2024, 3, 2))
    assert ids(spark, table) == ["a", "b"]
    assert (report.received, report.stored) == (3, 2)
    assert load_batch(records.limit(0), job, 8, datetime(2024, 3, 2)) is None


def test_stream_and_batch_load_share_a_table(spark, table, folder):
    job = job_for(table, folder)
    land(spark, job, [event("a")])
    run_ingest(spark, job)
    records = spark.createDataFrame([("k", event("b").encode())], WIRE_SCHEMA)
    load_batch(records, job, 0, datetime(2024, 3, 2))
    assert ids(spark, table) == ["a", "b"]


def test_progress_is_logged(spark, table, folder, caplog):
    listener = ProgressLog()
    spark.streams.addListener(listener)
    try:
        with caplog.at_level(logging.INFO, logger="tidemark"):
            job = job_for(table, folder)
            land(spark, job, [event("a"), event("b")])
            run_ingest(spark, job)
            for _ in range(50):
                if "ended" in caplog.text:
                    break
                time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert "batch 0 took" in caplog.text
    assert "stored=2" in caplog.text
    assert "started" in caplog.text and "ended" in caplog.text


def test_no_python_in_the_default_stream(spark, folder):
    spark.createDataFrame([], WIRE_SCHEMA).write.parquet(f"{folder}/wire")
    rows = event_rows(spark, job_for("t", folder)).agg(F.count(F.lit(1)))
    assert "Python" not in rows._jdf.queryExecution().analyzed().toString()
