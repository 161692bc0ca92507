"""The micro-batch sink: deduplicate, then store so that a replay changes nothing."""

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.decode import INGEST_DATE
from tidemark.operators.dedup import dedup_batch, without_stored
from tidemark.operators.quarantine import PAYLOAD_TEXT
from tidemark.session import settings
from tidemark.tables.event_table import (
    BatchReport,
    TableSpec,
    ids_of_days,
    store_batch,
    store_split_batch,
)

COPIES = "_copies"
QUERY_ID = "sql.streaming.queryId"

FILES_BY_SIZE = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITIONS = "spark.sql.shuffle.partitions"
TASK_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

# Compressed bytes that a task gets from the shuffle and sorts: up to some thirty times as
# many in memory.
TASK_BYTES = 16 * 1024**2

log = logging.getLogger(__name__)


def write_settings(spark: SparkSession) -> dict[str, str]:
    """How to shuffle and cut up a batch that is written.

    By default AQE makes as many files as the cluster has cores; files of an
    advisory size are what a table of many batches needs, one that a task can sort
    in little memory. AQE can merge shuffle partitions but not cut them, so it starts
    from more than there are cores.
    """
    cores = spark.sparkContext.defaultParallelism
    partitions = max(int(spark.conf.get(PARTITIONS)), 2 * cores)
    return {
        FILES_BY_SIZE: "false",
        FIRST_PARTITIONS: str(partitions),
        TASK_SIZE: str(TASK_BYTES),
    }


@dataclass(frozen=True)
class Storing:
    """How micro-batches are stored.

    ``unique`` says that ids are unique in each batch already: its rows are written by the
    tasks that hold them, without a shuffle. ``quarantine`` takes the records that do not
    decode, out of the table; rows are marked then. With ``dedup_days`` ids that the table
    got on the day of the batch or so many days before are left out.
    """

    target: TableSpec
    unique: bool = False
    quarantine: TableSpec | None = None
    dedup_days: int | None = None


def new_rows(how: Storing, rows: DataFrame, stream: str, batch_id: int) -> DataFrame:
    """One row per event, or per undecodable payload, with the number of its copies."""
    if how.unique:
        return rows.withColumn(COPIES, F.lit(1))
    apart = (PAYLOAD_TEXT,) if how.quarantine else ()
    folded = dedup_batch(rows, within=apart, copies=COPIES)
    if how.dedup_days is None:
        return folded
    first = rows.select(INGEST_DATE).head()
    if first is None:
        return folded
    spark = rows.sparkSession
    stored = ids_of_days(spark, how.target.name, first[0], how.dedup_days, stream, batch_id)
    return folded if stored is None else without_stored(folded, stored)


def store_micro_batch(
    how: Storing | TableSpec,
    rows: DataFrame,
    stream: str,
    batch_id: int,
    between: Callable[[int], None] | None = None,
) -> BatchReport | None:
    """Deduplicate and store one batch in a single pass; None if it is empty.

    An empty batch creates no table.
    """
    how = Storing(how) if isinstance(how, TableSpec) else how
    target = how.target
    spark = rows.sparkSession
    with settings(spark, write_settings(spark)):
        kept = new_rows(how, rows, stream, batch_id)
        if how.quarantine:
            report = store_split_batch(
                spark, target, how.quarantine, kept, stream, batch_id, COPIES, between
            )
        else:
            report = store_batch(spark, target, kept, stream, batch_id, COPIES)
    if report is None:
        log.info("batch %d for %s is empty, skipped", batch_id, target.name)
    else:
        log.info("stored in %s: %s", target.name, report)
    return report


class TableSink:
    """A ``foreachBatch`` function that stores micro-batches.

    It remembers the ``report`` of the last one; those of all are in the list of batches
    (``batch_list``). ``after_write`` is called with the number of each stored batch before
    the stream commits it, ``between`` between the parts of a batch with a quarantine.
    """

    def __init__(
        self,
        how: Storing,
        after_write: Callable[[int], None] | None = None,
        between: Callable[[int], None] | None = None,
    ):
        self.how = how
        self.after_write = after_write
        self.between = between
        self.report: BatchReport | None = None

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        stream = rows.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        try:
            report = store_micro_batch(self.how, rows, stream, batch_id, self.between)
        except Exception:
            log.exception("batch %d for %s failed", batch_id, self.how.target.name)
            raise
        if report is None:
            return
        self.report = report
        if self.after_write:
            self.after_write(batch_id)
