"""Run by test_failures: stores batches while tasks fail half-way, prints counts."""

import json
import sys
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent.parent))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators.decode import stamp  # noqa: E402
from tidemark.session import local_session, work_dir  # noqa: E402
from tidemark.sources.stream import Source  # noqa: E402
from tidemark.sources.synth import payment_run  # noqa: E402
from tidemark.sources.wire import encode  # noqa: E402
from tidemark.streaming.ingest import IngestJob, load_batch  # noqa: E402
from tidemark.tables.event_table import (  # noqa: E402
    TableSpec,
    create_namespace,
    current,
    store_batch,
)

ROWS = 5000
AT = datetime(2024, 3, 1)


def fail_half_way(batches):
    """The first attempt of every task hands on a batch, then fails."""
    for batch in batches:
        yield batch
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")


def main():
    spark = local_session("flaky", "4,4")
    spark.sparkContext.setLogLevel("OFF")
    folder = work_dir(spark, "flaky")
    create_namespace(spark, "flaky", f"{folder}/db")

    # Tasks fail before the shuffle, while records are read.
    records = encode(payment_run(spark, 10, 500, AT))
    read = records.unionByName(records).mapInArrow(fail_half_way, records.schema)
    job = IngestJob("j", Source(), TableSpec("flaky.read"), "subscription_payment", folder)
    report = load_batch(read, job, 0, AT)

    # Tasks fail after the shuffle, while files are written.
    rows = stamp(payment_run(spark, 10, 500, AT).select("event_id"), AT).repartition(4)
    store_batch(
        spark, TableSpec("flaky.write"), rows.mapInArrow(fail_half_way, rows.schema), "s", 0
    )

    def counts(table):
        stored = current(spark, table)
        return stored.agg(F.count("event_id"), F.count_distinct("event_id")).first()[:]

    print(json.dumps([report.stored, *counts("flaky.read"), *counts("flaky.write")]))
    spark.stop()


if __name__ == "__main__":
    main()
