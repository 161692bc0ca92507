"""Command line of an ingest job, for ``spark-submit``."""

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidemark.operators.decode import EVENT_TIME, INGEST_TIME
from tidemark.schemas import WIRE_FIELDS
from tidemark.sources.stream import LATEST, Source
from tidemark.tables.event_table import TableSpec, create_namespace
from tidemark.streaming.ingest import IngestJob, run_ingest
from tidemark.streaming.progress import ProgressLog


def parse(argv: Sequence[str] | None = None) -> IngestJob:
    """The job that the command line describes."""
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--job-name", required=True)
    args.add_argument("--table", required=True, help="database.table to write")
    args.add_argument("--schema", required=True, choices=list(WIRE_FIELDS))
    args.add_argument("--checkpoint", required=True, help="folder all executors share")
    args.add_argument("--location", help="folder of the table, if not the catalog's choice")
    args.add_argument("--provider", default="parquet", help="file format of the table")
    args.add_argument("--quarantine", help="database.table for records that do not decode")
    args.add_argument("--path", help="folder of wire records, for file sources")
    args.add_argument("--format", default="parquet", help="Spark format of the source")
    args.add_argument("--payload", help="column that holds the JSON text")
    args.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
    args.add_argument("--start", default=LATEST, help="LATEST or TRIM_HORIZON")
    args.add_argument("--dedup-delay", help="compare ids across batches, e.g. '10 days'")
    args.add_argument("--dedup-days", type=int, help="compare ids with those stored in N days")
    args.add_argument("--state-partitions", type=int, help="number of state stores")
    args.add_argument("--dedup-time", choices=[INGEST_TIME, EVENT_TIME], default=INGEST_TIME)
    args.add_argument("--interval", help="time between batches, e.g. '30 seconds'")
    args.add_argument("--once", action="store_true", help="stop when all input is read")
    args.add_argument("--evolve", action="store_true", help="add new columns to the table")
    given = args.parse_args(argv)
    trigger: dict[str, object] = {}
    if given.once:
        trigger["availableNow"] = True
    elif given.interval:
        trigger["processingTime"] = given.interval
    return IngestJob(
        job_name=given.job_name,
        source=Source(
            path=given.path,
            format=given.format,
            options=dict(pair.split("=", 1) for pair in given.option),
            payload=given.payload,
        ),
        table=TableSpec(given.table, given.provider, given.location, given.evolve),
        schema_name=given.schema,
        checkpoint=given.checkpoint,
        start=given.start,
        dedup_delay=given.dedup_delay,
        dedup_time=given.dedup_time,
        state_partitions=given.state_partitions,
        dedup_days=given.dedup_days,
        quarantine=given.quarantine and TableSpec(given.quarantine, given.provider),
        trigger=trigger,
    )


def main(argv: Sequence[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    job = parse(argv)
    spark = SparkSession.builder.appName(job.job_name).getOrCreate()
    spark.streams.addListener(ProgressLog())
    for table in filter(None, (job.table, job.quarantine)):
        database, _, _ = table.name.rpartition(".")
        if database:
            create_namespace(spark, database)
    run_ingest(spark, job)


if __name__ == "__main__":
    main()
