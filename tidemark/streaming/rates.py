"""Events per minute of a running stream, in a table of finished minutes."""

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.decode import EVENT_TIME, stamp
from tidemark.operators.dedup import dedup_across
from tidemark.operators.finance import events_per_minute
from tidemark.session import configure
from tidemark.streaming.ingest import IngestJob, RunningJob, event_rows, start_rows, wait
from tidemark.streaming.sink import Storing, TableSink


def rate_rows(spark: SparkSession, job: IngestJob, delay: str) -> DataFrame:
    """Finished minutes with the number of their events per type, each minute once.

    A minute is finished when the watermark, ``delay`` behind the latest event, has passed
    it. An event that is delivered again counts once, which also makes every late row one
    that the deduplication before the counts leaves out and reports by itself
    (``late_rows``). Rows without event time belong to no minute.
    """
    rows = dedup_across(event_rows(spark, job), delay, EVENT_TIME)
    return stamp(events_per_minute(rows))


def run_rates(spark: SparkSession, job: IngestJob, delay: str) -> RunningJob:
    """Store finished minutes in the table of a job until it ends; replays store them once."""
    configure(spark)
    rows = rate_rows(spark, job, delay)
    return wait(start_rows(spark, job, rows, TableSink(Storing(job.table, unique=True))))


def late_rows(running: RunningJob) -> int:
    """How many rows came behind the watermark, as far as the query's progress goes back."""
    states = (op for p in running.query.recentProgress for op in p.stateOperators)
    return sum(op.numRowsDroppedByWatermark for op in states)
