from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators.revenue import (
    event_mix,
    ingest_latency,
    latency_ms,
    latency_quantiles,
    revenue_by,
    with_status,
)

AT = datetime(2024, 3, 1, 12)


def test_latency(spark):
    """Exact counts, and quantiles within the rank error of the sketch."""
    delays = [(7919 * n) % 50_000 for n in range(50_000)]
    rows = spark.range(50_000).select(
        F.lit("2024-03-01 12:00:00").cast("timestamp").alias("event_timestamp"),
        F.timestamp_millis(
            F.unix_millis(F.lit("2024-03-01 12:00:00").cast("timestamp"))
            + F.pmod(F.col("id") * 7919, F.lit(50_000))
        ).alias("ingestion_timestamp"),
    )
    row = ingest_latency(rows).first()
    assert (row["n_events"], row["min_ms"], row["max_ms"]) == (50_000, 0, 49_999)
    assert row["within_second"] == sum(d <= 1000 for d in delays)
    assert row["within_minute"] == 50_000
    # A sketch per batch, merged on read.
    batches = rows.groupBy(F.spark_partition_id())
    sketches = batches.agg(F.kll_sketch_agg_bigint(latency_ms()).alias("latency"))
    found = latency_quantiles(sketches).first()
    assert abs(found["p50_ms"] - 25_000) <= 1_000 and abs(found["p95_ms"] - 47_500) <= 1_000


def test_rows_without_event_time_have_no_latency(spark):
    rows = spark.createDataFrame(
        [(AT, AT + timedelta(seconds=2)), (None, AT)],
        "event_timestamp TIMESTAMP, ingestion_timestamp TIMESTAMP",
    )
    row = ingest_latency(rows).first()
    assert (row["n_events"], row["min_ms"], row["within_second"]) == (1, 2000, 0)


def test_refunds_count_as_succeeded_and_net_out(spark):
    rows = spark.createDataFrame(
        [
            ("payment.succeeded", "succeeded", False, "basic", 9.99),
            ("payment.succeeded", "succeeded", False, "basic", 9.99),
            ("payment.refunded", "succeeded", True, "basic", -9.99),
            ("payment.failed", "failed", False, "basic", 0.0),
            (None, None, None, None, None),
        ],
        "event_type STRING, status STRING, is_refund BOOLEAN, tier STRING, amount_usd DOUBLE",
    )
    found = revenue_by(with_status(rows, "succeeded"), "tier", "amount_usd").collect()
    assert [tuple(r) for r in found] == [("basic", 3, 9.99)]
    mix = {r["event_type"]: (r["n_events"], r["amount_usd"]) for r in event_mix(rows).collect()}
    assert mix["payment.succeeded"] == (2, 19.98)
    assert mix[None] == (1, None)


def test_small_and_large_amounts_are_not_cut(spark):
    small = spark.range(1_000_000).select(F.lit("a").alias("k"), F.lit(4e-7).alias("x"))
    large = spark.range(1000).select(F.lit("b").alias("k"), F.lit(1e9 + 0.004).alias("x"))
    found = {r["k"]: r["revenue_usd"] for r in revenue_by(small.union(large), "k", "x").collect()}
    assert abs(found["a"] - 0.4) < 1e-9
    assert abs(found["b"] - 1_000_000_000_004.0) < 0.01


def test_flagship_plan(spark, folder):
    """One shuffle, three columns read, the filter pushed into the scan."""
    names = [f"c{n} STRING" for n in range(5)]
    schema = ", ".join(["status STRING, tier STRING, amount_usd DOUBLE", *names])
    spark.createDataFrame([], schema).write.parquet(folder)
    rows = spark.read.schema(schema).parquet(folder)
    frame = revenue_by(with_status(rows, "succeeded"), "tier", "amount_usd")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "EqualTo(status,succeeded)" in plan
    assert "ReadSchema: struct<status:string,tier:string,amount_usd:double>" in plan
    assert "SortAggregate" not in plan
