"""The registered queries: name to a function of session and table folder.

Queries that store a table write it below the folder named by
``spark.checkpoint.dir`` and return a read of it.
"""

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField

from tidemark.operators.decode import EVENT_TIME, INGEST_DATE, INGEST_TIME, decode, fields_of
from tidemark.operators.dedup import dedup_batch
from tidemark.operators.finance import (
    ad_fill,
    events_per_minute,
    net_revenue,
    reconcile_invoices,
    refund_links,
    undecodable,
    unified_revenue,
    with_ratios,
)
from tidemark.operators.revenue import (
    event_mix,
    ingest_latency,
    latency_ms,
    latency_quantiles,
    revenue_by,
    with_status,
)
from tidemark.plans import inputs
from tidemark.plans.views import N_DELIVERIES
from tidemark.schemas import get_schema
from tidemark.session import configure, work_dir
from tidemark.sources.stream import LATEST, TRIM_HORIZON, Source, open_stream
from tidemark.sources.synth import payments
from tidemark.tables.event_table import (
    TableSpec,
    add_columns,
    as_of_batch,
    as_of_time,
    batch_list,
    create_namespace,
    read_table,
)
from tidemark.tables.upkeep import close_days, history_view
from tidemark.sources.wire import PARTITION_KEY, PAYLOAD, deliver, delivery_counts, encode, route
from tidemark.streaming.ingest import (
    IngestJob,
    event_rows,
    load_batch,
    run_all,
    run_ingest,
    start_rows,
    wait,
)
from tidemark.streaming.rates import run_rates
from tidemark.streaming.sink import TableSink, store_micro_batch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NAMESPACE = "revenue_raw"
SHARDS = 8

# The check SQL compares ids per delivery, so a delivery must be one micro-batch
# here, whatever its size.
WHOLE_DELIVERIES = {"maxBytesPerTrigger": str(2**62)}
STAMPS = (INGEST_TIME, INGEST_DATE)
# By which column of its table a feed is dealt to all cores.
DEAL_BY = {"payments": "event_id", "partner_invoices": "o_orderkey", "ad_revenue": "l_orderkey"}
# Rows a file, at least, with which hashes leave no file without any.
ROWS_FOR_ALL = 25


def query(function: Query) -> Query:
    """Register a query under the name of its function."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir.rstrip("/"))

    QUERIES[function.__name__] = run
    return function


# ---------------------------------------------------------------- batch queries


def cents(totals: DataFrame, column: str = "revenue_usd") -> DataFrame:
    """Totals rounded for comparison: the last digits of a sum of doubles depend on its order."""
    return totals.withColumn(column, F.round(column, 2))


@query
def revenue_by_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.feed(spark, sf_dir, "payments")
    return cents(revenue_by(with_status(rows, "succeeded"), "subscription_tier", "amount_usd"))


@query
def revenue_by_partner(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.feed(spark, sf_dir, "partner_invoices")
    return cents(revenue_by(with_status(rows, "paid"), "partner_name", "total_amount_usd"))


@query
def revenue_by_advertiser(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.feed(spark, sf_dir, "ad_revenue")
    return cents(revenue_by(rows, "advertiser_name", "revenue_usd"))


@query
def revenue_from_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship over redelivered wire records: decode, deduplicate, aggregate.

    Payloads are parsed for the four fields it reads, which are all that is shuffled.
    """
    records = encode(inputs.utc(inputs.deliveries(spark, sf_dir).drop("seq", "batch_id")))
    read = ("event_id", "status", "subscription_tier", "amount_usd")
    fields = fields_of(get_schema("subscription_payment"), read)
    rows = dedup_batch(decode(records, fields).select(*read))
    return cents(revenue_by(with_status(rows, "succeeded"), "subscription_tier", "amount_usd"))


@query
def filter_succeeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_status(inputs.feed(spark, sf_dir, "payments").drop("seq"), "succeeded")


@query
def event_mix_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = event_mix(inputs.feed(spark, sf_dir, "payments"))
    return cents(mix.withColumn("share", F.round("share", 6)), "amount_usd")


def _decoded(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    records = inputs.feed_records(spark, sf_dir, view)
    rows = decode(records, get_schema(inputs.FEED_SCHEMAS[view]))
    return inputs.zoneless(rows.drop(*STAMPS))


@query
def decode_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir, "payments")


@query
def decode_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir, "partner_invoices")


@query
def decode_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir, "ad_revenue")


@query
def decode_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.damaged_records(spark, sf_dir)
    rows = decode(records, get_schema("subscription_payment"), keep=("seq",))
    return inputs.zoneless(rows).select(
        "seq", "event_id", "event_timestamp", "status", "amount_usd", "is_refund", "payment_id"
    )


@query
def wire_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.feed_records(spark, sf_dir, "payments")
    return records.select(PARTITION_KEY, F.col(PAYLOAD).cast("string").alias(PAYLOAD))


@query
def customer_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route(inputs.feed_records(spark, sf_dir, "payments").select(PARTITION_KEY), SHARDS)
    return routed.groupBy(PARTITION_KEY).agg(
        F.min("shard").alias("shard"),
        F.max("shard").alias("last_shard"),
        F.count(F.lit(1)).alias("n_records"),
    )


@query
def delivery_counts_by_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records sent and refused per shard; every 97th payment names no customer."""
    rows = inputs.utc(inputs.feed(spark, sf_dir, "payments"))
    named = F.when(F.col("seq") % 97 != 0, F.col("customer_id"))
    records = encode(rows.withColumn("customer_id", named).drop("seq"))
    return delivery_counts(route(records, SHARDS), "shard")


@query
def synth_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = inputs.table(spark, sf_dir, "events")
    return payments(ticks, row="event_id", time="ts")


@query
def dedup_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = inputs.deliveries(spark, sf_dir).drop("seq")
    records = encode(inputs.utc(copies), keep=("batch_id",))
    rows = decode(records, get_schema("subscription_payment"), keep=("batch_id",))
    return inputs.zoneless(dedup_batch(rows, within=("batch_id",)).drop(*STAMPS))


@query
def dedup_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undecodable records of a batch fold into one row of NULLs."""
    copies = inputs.deliveries(spark, sf_dir)
    records = encode(inputs.utc(copies), keep=("batch_id", "seq"))
    read = ("batch_id", "event_id", "payment_id")
    fields = fields_of(get_schema("subscription_payment"), read[1:])
    rows = decode(inputs.cut_payload(records, 3), fields, keep=("batch_id",))
    return dedup_batch(rows.select(*read), within=("batch_id",)).select(*read)


@query
def net_revenue_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.feed(spark, sf_dir, "payments")
    totals = net_revenue(rows, "billing_period", "country_code", "payment_processor")
    for column in ("gross_usd", "refund_usd", "net_usd"):
        totals = cents(totals, column)
    return totals


@query
def unified_revenue_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = (inputs.feed(spark, sf_dir, view) for view in inputs.FEED_SCHEMAS)
    return cents(unified_revenue(*feeds))


@query
def refund_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refund_links(inputs.feed(spark, sf_dir, "payments"))


@query
def event_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per minute and type."""
    rows = events_per_minute(inputs.utc(inputs.feed(spark, sf_dir, "payments")))
    return rows.withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query
def invoice_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices that differ from what their subscriptions make up."""
    rows = reconcile_invoices(inputs.feed(spark, sf_dir, "partner_invoices"))
    return rows.filter("difference_usd <> 0")


@query
def ad_fill_by_advertiser(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = ad_fill(inputs.feed(spark, sf_dir, "ad_revenue"), "advertiser_name", "billing_period")
    ratios = cents(with_ratios(sums))
    return cents(ratios.withColumn("fill_rate", F.round("fill_rate", 4)), "revenue_per_thousand")


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that do not decode, whole, beside the payment each came from."""
    rows = inputs.utc(inputs.feed(spark, sf_dir, "payments"))
    records = inputs.cut_payload(
        encode(rows.withColumn("row", F.col("seq")), keep=("seq", "row")), 5
    ).select("row", PAYLOAD)
    decoded = decode(records, get_schema("subscription_payment"), keep=("row", PAYLOAD))
    return undecodable(records, decoded, PAYLOAD)


# ------------------------------------------------------- tables loaded in batch


def _job(
    spark: SparkSession, name: str, schema: str = "subscription_payment", **more: object
) -> IngestJob:
    """A job on a fresh table, checkpoint and landing folder below one work folder."""
    folder = work_dir(spark, name)
    create_namespace(spark, NAMESPACE, work_dir(spark, NAMESPACE))
    table = f"{NAMESPACE}.{folder.rsplit('/', 1)[1].replace('-', '_')}"
    return IngestJob(
        job_name=name,
        source=Source(path=f"{folder}/wire", options=WHOLE_DELIVERIES),
        table=TableSpec(table, location=f"{folder}/table"),
        schema_name=schema,
        checkpoint=f"{folder}/checkpoint",
        **{"start": TRIM_HORIZON, "trigger": {"availableNow": True}, **more},
    )


def _load(spark: SparkSession, sf_dir: str, name: str, *numbers: int) -> IngestJob:
    """Load deliveries as numbered batches, each at its own time."""
    job = _job(spark, name)
    for number in numbers or range(N_DELIVERIES):
        records = inputs.delivery_records(spark, sf_dir, number)
        load_batch(records, job, number, inputs.load_time(number))
    return job


def _stored(spark: SparkSession, job: IngestJob) -> DataFrame:
    return inputs.zoneless(read_table(spark, job.table.name).drop(*STAMPS))


@query
def table_create_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skip an empty batch, create from the next, append, load one batch again."""
    job = _job(spark, "create_append")
    nothing = inputs.delivery_records(spark, sf_dir, 0).limit(0)
    load_batch(nothing, job, N_DELIVERIES, inputs.load_time(0))
    for number in (*range(N_DELIVERIES), 1):
        records = inputs.delivery_records(spark, sf_dir, number)
        load_batch(records, job, number, inputs.load_time(number))
    return _stored(spark, job)


@query
def as_of_batch_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _load(spark, sf_dir, "as_of_batch")
    return inputs.zoneless(as_of_batch(spark, job.table.name, 2).drop(*STAMPS))


@query
def as_of_time_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _load(spark, sf_dir, "as_of_time")
    rows = as_of_time(spark, job.table.name, inputs.load_time(1))
    return inputs.zoneless(rows.drop(*STAMPS))


@query
def ingest_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _load(spark, sf_dir, "ingest_columns")
    rows = read_table(spark, job.table.name)
    return rows.groupBy(
        F.col(INGEST_TIME).cast("timestamp_ntz").alias(INGEST_TIME), INGEST_DATE
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def latency_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact latency counts of each load, and whether the sketched quantiles have their rank.

    Quantiles are those of the list of batches; the share of events below and up to each
    must enclose what it stands for, within 2.5 percent.
    """
    job = _load(spark, sf_dir, "latency")
    week = 7 * 24 * 3_600_000
    limits = {"within_week": week, "within_month": 4 * week}
    rows = read_table(spark, job.table.name)
    quantiles = latency_quantiles(batch_list(spark, job.table.name), INGEST_DATE)
    shares = rows.join(quantiles, INGEST_DATE).groupBy(INGEST_DATE)
    delay = latency_ms()
    ranks = shares.agg(
        *(
            (
                (F.avg((delay < F.col(column)).cast("int")) <= share + 0.025)
                & (F.avg((delay <= F.col(column)).cast("int")) >= share - 0.025)
            ).alias(f"{column[:3]}_in_rank")
            for column, share in (("p50_ms", 0.5), ("p95_ms", 0.95))
        )
    )
    return ingest_latency(rows, INGEST_DATE, limits_ms=limits).join(ranks, INGEST_DATE)


@query
def batch_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the table's list says each batch brought, a fifth of it undecodable."""
    job = _job(spark, "reports")
    for number in range(N_DELIVERIES):
        rows = inputs.utc(inputs.delivery_rows(spark, sf_dir, number))
        records = inputs.cut_payload(encode(rows, keep=("seq",)), 5)
        load_batch(records, job, number, inputs.load_time(number))
    listed = batch_list(spark, job.table.name)
    return listed.select("batch_id", "received", "undecodable", "stored")


@query
def concurrent_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaders of one session side by side, on one day, new batches and rewrites: all stay."""
    job = _job(spark, "concurrent")
    day = inputs.load_time(0)

    def load(number: int) -> None:
        load_batch(inputs.delivery_records(spark, sf_dir, number), job, number, day)

    load(0)
    with ThreadPoolExecutor(N_DELIVERIES) as pool:
        list(pool.map(load, [*range(N_DELIVERIES), 1, 2]))
    return _stored(spark, job)


@query
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column is added by hand, another comes with the rows of later batches.

    Rows stored before that read NULL in both.
    """
    job = _load(spark, sf_dir, "evolution", 0, 1)
    add_columns(spark, job.table.name, [StructField("is_trial", BooleanType())])
    target = replace(job.table, evolve=True)
    for number in range(2, N_DELIVERIES):
        records = inputs.delivery_records(spark, sf_dir, number)
        rows = decode(
            records, get_schema(job.schema_name), ingested_at=inputs.load_time(number)
        ).withColumn("is_free", F.col("amount_usd") == 0)
        store_micro_batch(target, rows, job.job_name, number)
    return _stored(spark, job)


@query
def revenue_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship as SQL text over an ingested table."""
    job = _load(spark, sf_dir, "revenue_sql")
    return spark.sql(
        "SELECT subscription_tier, COUNT(*) AS n_events, "
        "ROUND(SUM(amount_usd), 2) AS revenue_usd "
        f"FROM {job.table.name} WHERE status = 'succeeded' GROUP BY subscription_tier"
    )


@query
def codec_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the compression codec that the names of their files give."""
    job = _load(spark, sf_dir, "codec")
    codec = F.regexp_extract(F.col("_metadata.file_name"), r"\.(\w+)\.parquet$", 1)
    rows = spark.table(job.table.name).select(codec.alias("codec"))
    return rows.groupBy("codec").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def closed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History over compacted days and live batches, as of batch 3."""
    job = _load(spark, sf_dir, "closed_days")
    table = job.table.name
    close_days(spark, table, f"{table}_closed", before=inputs.load_time(3).date())
    history_view(spark, table, f"{table}_closed", f"{table}_all")
    return inputs.zoneless(as_of_batch(spark, f"{table}_all", 3).drop(*STAMPS))


# ------------------------------------------------------------ streaming queries


def _land(spark: SparkSession, sf_dir: str, job: IngestJob, *numbers: int) -> None:
    for number in numbers:
        deliver(inputs.delivery_records(spark, sf_dir, number), job.source.path, SHARDS)


def _stream(spark: SparkSession, sf_dir: str, job: IngestJob) -> IngestJob:
    """Let the deliveries arrive one after the other, each its own micro-batch."""
    for number in range(N_DELIVERIES):
        _land(spark, sf_dir, job, number)
        run_ingest(spark, job)
    return job


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _stream(spark, sf_dir, _job(spark, "stream"))
    return _stored(spark, job)


@query
def stream_ingest_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stamp per micro-batch, the date that of the stamp."""
    job = _stream(spark, sf_dir, _job(spark, "stream_columns"))
    stamps = (
        spark.table(job.table.name)
        .groupBy("_batch_id")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(INGEST_TIME).alias("n_stamps"),
            F.bool_and(F.col(INGEST_TIME).cast("date") == F.col(INGEST_DATE)).alias("same_day"),
        )
    )
    return stamps.withColumnRenamed("_batch_id", "batch_id")


@query
def stream_ingest_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crash between write and commit of one batch, then a restart."""
    job = _job(spark, "stream_replay")

    def crash(batch_id: int) -> None:
        raise RuntimeError(f"stopped after the write of batch {batch_id}")

    for number in range(N_DELIVERIES):
        _land(spark, sf_dir, job, number)
        if number == 2:
            try:
                run_ingest(spark, job, after_write=crash)
            except Exception as error:
                if "stopped after the write" not in str(error):
                    raise
        run_ingest(spark, job)
    return _stored(spark, job)


def _stream_across(spark: SparkSession, sf_dir: str, name: str, time: str) -> DataFrame:
    job = _job(
        spark,
        name,
        dedup_delay="20 days",
        dedup_time=time,
        state_partitions=spark.sparkContext.defaultParallelism,
    )
    return _stored(spark, _stream(spark, sf_dir, job))


@query
def stream_dedup_ingest_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_across(spark, sf_dir, "stream_ingest_time", INGEST_TIME)


@query
def stream_dedup_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_across(spark, sf_dir, "stream_watermark", EVENT_TIME)


@query
def stream_dedup_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids compared across batches without state, with those the table holds already."""
    return _stored(spark, _stream(spark, sf_dir, _job(spark, "stream_history", dedup_days=20)))


@query
def stream_event_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished minutes of a stream; copies that come behind the watermark change none."""
    job = _job(spark, "stream_rate", state_partitions=spark.sparkContext.defaultParallelism)
    for number in range(N_DELIVERIES):
        _land(spark, sf_dir, job, number)
        run_rates(spark, job, "2 days")
    rows = read_table(spark, job.table.name).drop(*STAMPS)
    return rows.withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that do not decode, beside the table; one batch crashes between its two parts."""
    job = _job(spark, "stream_quarantine")
    aside = TableSpec(f"{job.table.name}_lost", location=f"{job.table.location}_lost")
    job = replace(job, quarantine=aside)
    records = inputs.damaged_records(spark, sf_dir)
    n_batches = 3

    def crash(batch_id: int) -> None:
        raise RuntimeError("stopped between the parts")

    for number in range(n_batches):
        landed = records.filter(F.col("seq") % n_batches == number)
        landed = landed.select(F.lit("k").alias(PARTITION_KEY), PAYLOAD)
        landed.write.mode("append").parquet(job.source.path)
        if number == 1:
            try:
                sink = TableSink(job.storing, between=crash)
                wait(start_rows(spark, job, event_rows(spark, job), sink))
            except Exception as error:
                if "stopped between the parts" not in str(error):
                    raise
        run_ingest(spark, job)
    lost = read_table(spark, aside.name).groupBy("payload", "cause")
    return lost.agg(F.sum("n_records").alias("n_records"))


@query
def stream_from_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that is no file, with offsets of its own: it goes on from them after restarts.

    The source counts; each number stands for the payment that bears it.
    """
    payments = inputs.utc(inputs.feed(spark, sf_dir, "payments"))
    last = payments.agg(F.max("seq")).first()[0]
    runs = 3
    per_run = {"rowsPerBatch": str(last // runs + 1), "numPartitions": str(SHARDS)}
    source = Source(format="rate-micro-batch", options=per_run)
    job = replace(_job(spark, "stream_source"), source=source)
    records = encode(payments.withColumn("n", F.col("seq")), keep=("n", "seq")).drop("seq")
    for _ in range(runs):
        ticks = open_stream(spark, source, TRIM_HORIZON, job.checkpoint)
        sent = ticks.join(records, F.col("value") == F.col("n")).select(PAYLOAD)
        rows = decode(sent, get_schema(job.schema_name))
        wait(start_rows(spark, job, rows, TableSink(job.storing)))
    return _stored(spark, job)


@query
def stream_shard_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries read from shards with an offset each, a restart after every one."""
    job = _job(spark, "stream_shards")
    job = replace(job, source=Source(path=job.source.path, format="sharded_log"))
    return _stored(spark, _stream(spark, sf_dir, job))


@query
def stream_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options reach the source: a backlog is read so many files at a time, in the order of arrival.

    A delivery is that many files, or one if it is too small to have rows for each.
    """
    job = _job(spark, "stream_options")
    sizes = inputs.deliveries(spark, sf_dir).groupBy("batch_id").count()
    # Fewer files of the last delivery take no others into its batch.
    full = sizes.filter(F.col("batch_id") < N_DELIVERIES - 1).filter(
        F.col("count") >= ROWS_FOR_ALL * SHARDS
    )
    files = min(SHARDS, inputs.n_tasks(spark)) if full.count() == N_DELIVERIES - 1 else 1
    some = Source(path=job.source.path, options={"maxFilesPerTrigger": str(files)})
    job = replace(job, source=some)
    for number in range(N_DELIVERIES):
        records = inputs.delivery_records(spark, sf_dir, number).coalesce(files)
        records.write.mode("append").parquet(job.source.path)
    run_ingest(spark, job)
    return batch_list(spark, job.table.name).select("batch_id", "received")


@query
def start_position_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What had landed before the first start is left out, across restarts too."""
    job = _job(spark, "start_latest", start=LATEST)
    _land(spark, sf_dir, job, 0, 1)
    # LATEST counts in whole seconds; land the rest in a later one.
    time.sleep(2)
    run_ingest(spark, job)
    for number in range(2, N_DELIVERIES):
        _land(spark, sf_dir, job, number)
        run_ingest(spark, job)
    return _stored(spark, job)


@query
def three_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three feeds ingested side by side; rows and amount of each."""
    amounts = {
        "payments": "amount_usd",
        "partner_invoices": "total_amount_usd",
        "ad_revenue": "revenue_usd",
    }
    jobs = {
        view: _job(spark, f"feed_{view}", inputs.FEED_SCHEMAS[view]) for view in amounts
    }

    def land(view: str) -> None:
        records = inputs.feed_records(spark, sf_dir, view, DEAL_BY[view])
        deliver(records, jobs[view].source.path, SHARDS)

    with ThreadPoolExecutor(len(jobs)) as pool:
        list(pool.map(land, jobs))
    run_all(spark, list(jobs.values()))
    totals = None
    for view, job in jobs.items():
        rows = read_table(spark, job.table.name).withColumn("feed", F.lit(view))
        total = cents(revenue_by(rows, "feed", amounts[view]))
        totals = total if totals is None else totals.unionByName(total)
    return totals
