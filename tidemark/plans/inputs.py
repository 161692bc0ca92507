"""Spark inputs of the registered queries: feeds, deliveries, damaged records."""

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.views import AGAIN, CUTS, FIRST_DELIVERY, SOURCES, TEXTS, TWICE
from tidemark.sources.wire import PAYLOAD, encode

FEED_KEYS = {
    "payments": "customer_id",
    "partner_invoices": "partner_name",
    "ad_revenue": "advertiser_name",
}
FEED_SCHEMAS = {
    "payments": "subscription_payment",
    "partner_invoices": "partner_invoice",
    "ad_revenue": "ad_revenue",
}

# When delivery n is loaded, for batch loads that name their own time.
FIRST_LOAD = datetime(2024, 2, 1, 6)
LOAD_EVERY = timedelta(days=1)


def load_time(delivery: int) -> datetime:
    return FIRST_LOAD + delivery * LOAD_EVERY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Tasks for each core that rows are dealt to.
TASKS_PER_CORE = 4


def n_tasks(spark: SparkSession) -> int:
    return TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def feed(spark: SparkSession, sf_dir: str, view: str, deal_by: str = "") -> DataFrame:
    """One of the derived feeds; unused columns are pruned down to the scan.

    ``deal_by`` names a column of the table by whose hash its rows, narrow as they still
    are, are dealt evenly to all cores. A filter is applied before. Without it the files
    decide, and a few days of a table that is sorted by time are in one or two splits.
    """
    source = SOURCES[view]
    scan = table(spark, sf_dir, source)
    if deal_by:
        scan = scan.repartition(n_tasks(spark), deal_by)
    return spark.sql(
        f"WITH {source} AS (SELECT * FROM {{scan}}), {TEXTS[view].strip()} SELECT * FROM {view}",
        scan=scan,
    )


def utc(rows: DataFrame) -> DataFrame:
    """The zoneless event times of the test tables as moments in UTC."""
    return rows.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


def zoneless(rows: DataFrame) -> DataFrame:
    """Event times back in the type of the test tables."""
    return rows.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def feed_records(spark: SparkSession, sf_dir: str, view: str, deal_by: str = "") -> DataFrame:
    """A feed as wire records."""
    rows = feed(spark, sf_dir, view, deal_by)
    return encode(utc(rows.drop("seq")), FEED_KEYS[view])


def deliveries(spark: SparkSession, sf_dir: str, deal_by: str = "") -> DataFrame:
    """Payments with every copy that is delivered, and the delivery it is in."""
    first = F.expr(FIRST_DELIVERY).cast("bigint")
    copies = (
        F.when(F.expr(TWICE), F.array(first, first))
        .when(F.expr(AGAIN), F.array(first, first + 1))
        .otherwise(F.array(first))
    )
    rows = feed(spark, sf_dir, "payments", deal_by)
    return rows.withColumn("batch_id", F.explode(copies))


def delivery_rows(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """One delivery; only the days it can hold are read, and dealt to all cores."""
    days = [None, None, *CUTS, None, None]
    since, until = days[number], days[number + 2]
    rows = deliveries(spark, sf_dir, deal_by="event_id")
    if since:
        rows = rows.filter(F.col("event_timestamp") >= F.to_date(F.lit(since)))
    if until:
        rows = rows.filter(F.col("event_timestamp") < F.to_date(F.lit(until)))
    return rows.filter(F.col("batch_id") == number).drop("batch_id")


def delivery_records(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    return encode(utc(delivery_rows(spark, sf_dir, number).drop("seq")))


def cut_payload(records: DataFrame, every: int) -> DataFrame:
    """Records with the payload of every nth payment cut short; drops ``seq``."""
    cut = F.when(F.col("seq") % every == 0, F.substring(PAYLOAD, 1, 40)).otherwise(F.col(PAYLOAD))
    return records.withColumn(PAYLOAD, cut).drop("seq")


def damaged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every payment as a payload that is damaged in one of thirteen ways.

    Columns: ``seq``, and the payload. The kind of damage is ``seq % 13``.
    """
    rows = feed(spark, sf_dir, "payments")
    kind = F.col("seq") % 13
    body = F.concat(
        F.lit('"status":"'), F.col("status"), F.lit('","amount_usd":'), F.col("amount_usd")
    )

    def payload(*parts: Column | str) -> Column:
        return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))

    start = payload('{"event_id":"', F.col("event_id"), '",')
    whole = payload(start, body, ',"is_refund":false}')
    texts = {
        0: whole,
        1: payload("not json ", F.col("event_id")),
        2: F.lit(""),
        3: F.lit(None).cast("string"),
        4: payload(start, body),
        5: payload(start, '"status":"open","amount_usd":"abc"}'),
        6: payload(start, body, ',"is_refund":"true"}'),
        7: payload('{"event_id":', F.col("seq"), ",", body, "}"),
        8: payload(start, '"event_timestamp":"yesterday"}'),
        9: payload(start, '"event_timestamp":"2024-01-15"}'),
        10: payload("[", whole, ",", whole, "]"),
        11: payload('{"EVENT_ID":"', F.col("event_id"), '","extra":{"a":[1,2]},', body, "}"),
        12: payload(start, '"event_timestamp":"2024-01-15T05:00:00.5+05:00"}'),
    }
    chosen = F.lit(None).cast("string")
    for number, text in texts.items():
        chosen = F.when(kind == number, text).otherwise(chosen)
    return rows.select("seq", F.encode(chosen, "UTF-8").alias(PAYLOAD))
