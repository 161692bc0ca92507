"""Times the registered queries and ingest; prints one line of JSON.

BENCH_SF_DIR names the folder with the test tables, BENCH_CPUS the cores to use.
Batch queries give the median of warm runs, queries that build a table or run a
stream the time of one run after a first one has warmed the JVM.
"""

import json
import logging
import os
import statistics
import sys
import time
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.plans import inputs
from tidemark.plans.catalog import QUERIES
from tidemark.session import local_session, work_dir
from tidemark.sources.stream import TRIM_HORIZON, Source
from tidemark.sources.wire import WIRE_SCHEMA, deliver
from tidemark.streaming.ingest import IngestJob, load_batch, run_ingest
from tidemark.tables.event_table import TableSpec, create_namespace, current

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
FLAGSHIP = "revenue_by_tier"
FLAGSHIP_RUNS = 5

WARM = [
    "revenue_by_tier",
    "revenue_by_partner",
    "revenue_by_advertiser",
    "revenue_from_wire",
    "filter_succeeded",
    "event_mix_shares",
    "decode_payments",
    "decode_invoices",
    "decode_ads",
    "decode_malformed",
    "wire_encode",
    "customer_routing",
    "delivery_counts_by_shard",
    "synth_payments",
    "dedup_in_batch",
    "dedup_null_keys",
]


def consume(frame):
    """Compute every row and column, and keep nothing."""
    frame.write.format("noop").mode("overwrite").save()


def timed(action):
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def time_queries(spark):
    seconds = {}
    for name, query in QUERIES.items():
        if name in WARM:
            consume(query(spark, SF_DIR))
            n = FLAGSHIP_RUNS if name == FLAGSHIP else RUNS
            runs = [timed(lambda: consume(query(spark, SF_DIR))) for _ in range(n)]
            seconds[name] = statistics.median(runs)
        else:
            seconds[name] = timed(lambda: consume(query(spark, SF_DIR)))
    return {name: round(s, 3) for name, s in seconds.items()}


def time_ingest(spark):
    """Rows per second of one large batch and of a stream of many; bytes per codec."""
    folder = work_dir(spark, "bench")
    create_namespace(spark, "bench", f"{folder}/db")
    wire = f"{folder}/wire"
    rows = sum(
        deliver(inputs.feed_records(spark, SF_DIR, "ad_revenue"), wire, 8)["delivered"]
        for _ in range(4)
    )

    def job(name):
        return IngestJob(
            job_name=name,
            source=Source(path=f"{wire}/*/", options={"maxFilesPerTrigger": "8"}),
            table=TableSpec(f"bench.{name}"),
            schema_name="ad_revenue",
            checkpoint=f"{folder}/{name}",
            start=TRIM_HORIZON,
            trigger={"availableNow": True},
        )

    records = spark.read.schema(WIRE_SCHEMA).parquet(wire)
    at = datetime(2024, 2, 1)
    batch = min(timed(lambda: load_batch(records, job("batch"), n, at)) for n in range(3))

    running = []
    stream = timed(lambda: running.append(run_ingest(spark, job("stream"))))
    durations = sorted(p.batchDuration for p in running[0].query.recentProgress if p.numInputRows)

    stored = current(spark, "bench.batch").filter("_batch_id = 0").drop("_stream", "_batch_id")
    sizes = {}
    for codec in ("zstd", "snappy", "gzip"):
        path = f"{folder}/{codec}"
        stored.coalesce(1).write.option("compression", codec).parquet(path)
        files = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size")
        sizes[codec] = files.distinct().agg(F.sum("file_size")).first()[0]
    return {
        "rows": rows,
        "batch_rows_per_sec": round(rows / batch),
        "stream_rows_per_sec": round(rows / stream),
        "stream_batches": len(durations),
        "batch_ms_p50": durations[len(durations) // 2],
        "batch_ms_p95": durations[int(len(durations) * 0.95)],
        "bytes_per_codec": sizes,
    }


def main():
    logging.getLogger("py4j").setLevel(logging.CRITICAL)
    logging.getLogger("tidemark").setLevel(logging.CRITICAL)
    spark = local_session("bench", CPUS)
    spark.sparkContext.setLogLevel("OFF")
    queries = time_queries(spark)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": float(SF_DIR.rsplit("sf", 1)[-1]),
        "ingest": time_ingest(spark),
    }
    print(json.dumps(result))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
