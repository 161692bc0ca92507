"""Ingest jobs: one stream of one schema into one table, any number side by side."""

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.decode import INGEST_TIME, decode
from tidemark.operators.dedup import dedup_across
from tidemark.operators.quarantine import mark_undecodable
from tidemark.schemas import get_schema
from tidemark.session import configure, settings
from tidemark.sources.stream import LATEST, Source, open_stream
from tidemark.streaming.sink import Storing, TableSink, store_micro_batch
from tidemark.tables.event_table import BatchReport, TableSpec

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

STATE_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
STATE_PARTITIONS = "spark.sql.shuffle.partitions"
POOL = "spark.scheduler.pool"

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class IngestJob:
    """What to ingest and how.

    ``dedup_delay`` is None to compare event ids within each micro-batch, or a
    delay such as ``"10 days"`` to compare them across batches too, by
    ``dedup_time`` (see ``dedup_across``). ``state_partitions`` is the number of state stores
    that needs; it cannot change once the checkpoint exists. ``dedup_days`` compares them
    without state, with the ids that the table itself got in so many days; large batches
    suit it, as each reads those ids. ``quarantine`` is the table for records that do not
    decode. ``trigger`` is passed to ``DataStreamWriter.trigger``; without it batches follow
    each other as fast as they can.
    """

    job_name: str
    source: Source
    table: TableSpec
    schema_name: str
    checkpoint: str
    start: str = LATEST
    dedup_delay: str | None = None
    dedup_time: str = INGEST_TIME
    state_partitions: int | None = None
    dedup_days: int | None = None
    quarantine: TableSpec | None = None
    trigger: dict[str, object] = field(default_factory=dict)

    def __post_init__(self):
        if self.dedup_delay and (self.dedup_days is not None or self.quarantine):
            # State would fold undecodable records before they could be kept apart.
            raise ValueError("dedup_delay goes with neither dedup_days nor a quarantine")

    @property
    def storing(self) -> Storing:
        return Storing(self.table, bool(self.dedup_delay), self.quarantine, self.dedup_days)


@dataclass(frozen=True)
class RunningJob:
    """A started job: its query, and its sink."""

    query: StreamingQuery
    sink: TableSink


def event_rows(spark: SparkSession, job: IngestJob) -> DataFrame:
    """The decoded stream of a job, before it is cut into micro-batches."""
    rows = _decoded(open_stream(spark, job.source, job.start, job.checkpoint), job)
    if not job.dedup_delay:
        return rows
    return dedup_across(rows, job.dedup_delay, job.dedup_time)


def _decoded(records: DataFrame, job: IngestJob, ingested_at: datetime | None = None) -> DataFrame:
    schema, payload = get_schema(job.schema_name), job.source.payload_column
    if not job.quarantine:
        return decode(records, schema, payload, ingested_at)
    return mark_undecodable(decode(records, schema, payload, ingested_at, (payload,)), payload)


def state_settings(job: IngestJob) -> dict[str, str]:
    """Settings of the state store, for jobs that keep state."""
    # State of days of event ids belongs on disk, not in the executor heap.
    values = {STATE_STORE: ROCKSDB, STATE_CHANGELOG: "true"}
    if job.state_partitions:
        values[STATE_PARTITIONS] = str(job.state_partitions)
    return values


def start_ingest(
    spark: SparkSession, job: IngestJob, after_write: Callable[[int], None] | None = None
) -> RunningJob:
    """Start a job; it runs until it is stopped, fails, or its trigger is done."""
    configure(spark)
    log.info("job %s: reading %s into %s", job.job_name, job.source, job.table.name)
    return start_rows(spark, job, event_rows(spark, job), TableSink(job.storing, after_write))


def start_rows(
    spark: SparkSession, job: IngestJob, rows: DataFrame, sink: TableSink
) -> RunningJob:
    """Start storing any stream of stamped rows the way a job says."""
    writer = (
        rows.writeStream.queryName(job.job_name)
        .foreachBatch(sink)
        .option("checkpointLocation", job.checkpoint)
    )
    if job.trigger:
        writer = writer.trigger(**job.trigger)
    # Under a FAIR scheduler each job gets its share, however large the others' batches.
    context = spark.sparkContext
    context.setLocalProperty(POOL, job.job_name)
    try:
        with settings(spark, state_settings(job)):
            query = writer.start()
    finally:
        context.setLocalProperty(POOL, None)
    log.info("job %s: started as query %s", job.job_name, query.id)
    return RunningJob(query, sink)


def run_ingest(
    spark: SparkSession, job: IngestJob, after_write: Callable[[int], None] | None = None
) -> RunningJob:
    """Run a job to its end; a failure of the stream is raised here."""
    return wait(start_ingest(spark, job, after_write))


def wait(running: RunningJob) -> RunningJob:
    """Wait for the end of a started job; a failure of the stream is raised here."""
    name = running.query.name
    try:
        running.query.awaitTermination()
    except Exception:
        log.exception("job %s failed", name)
        raise
    finally:
        log.info("job %s stopped", name)
    return running


def run_all(spark: SparkSession, jobs: Sequence[IngestJob]) -> list[RunningJob]:
    """Run several jobs in one session, each with its own checkpoint.

    Returns when the triggers of all jobs are done. The first failure stops the
    others and is raised.
    """
    places = [job.checkpoint for job in jobs]
    if len(set(places)) != len(places):
        raise ValueError("every job needs a checkpoint of its own")
    running: list[RunningJob] = []
    try:
        for job in jobs:
            running.append(start_ingest(spark, job))
        waiting = [r.query for r in running]
        while waiting:
            waiting = [q for q in waiting if not q.awaitTermination(1)]
    finally:
        for r in running:
            r.query.stop()
    return running


def load_batch(
    records: DataFrame, job: IngestJob, batch_id: int, ingested_at: datetime
) -> BatchReport | None:
    """Ingest a static set of records as one batch, the way the stream would.

    A retry with the same number and stamp replaces what the first try stored.
    Batches loaded this way are kept apart from streams by the name of the job.
    """
    rows = _decoded(records, job, ingested_at)
    return store_micro_batch(job.storing, rows, job.job_name, batch_id)
