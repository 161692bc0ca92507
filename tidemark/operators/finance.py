"""Net revenue, refunds, invoices and ads: aggregates and joins over the feeds."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.decode import EVENT_TIME


def net_revenue(payments: DataFrame, *keys: str) -> DataFrame:
    """Gross, refunded and net amount per key, of payments that succeeded.

    Refunds bear a negative amount; ``refund_usd`` is given as a positive one. Their
    sum is 0 where there are none.
    """
    refund = F.coalesce("is_refund", F.lit(False))
    amount = F.col("amount_usd")
    return (
        payments.filter(F.col("status") == "succeeded")
        .groupBy(*keys)
        .agg(
            F.sum(F.when(~refund, amount).otherwise(0.0)).alias("gross_usd"),
            F.sum(F.when(refund, -amount).otherwise(0.0)).alias("refund_usd"),
            F.sum(amount).alias("net_usd"),
        )
    )


def unified_revenue(payments: DataFrame, invoices: DataFrame, ads: DataFrame) -> DataFrame:
    """Revenue of the three feeds per billing period, country and feed.

    Payments count if they succeeded, refunds against them; invoices if they are paid.
    """
    keys = ("billing_period", "country_code")
    parts = [
        (payments.filter(F.col("status") == "succeeded"), "payments", "amount_usd"),
        (invoices.filter(F.col("status") == "paid"), "partner_invoices", "total_amount_usd"),
        (ads, "ad_revenue", "revenue_usd"),
    ]
    rows = [
        p.select(*keys, F.lit(feed).alias("feed"), F.col(amount).alias("amount"))
        for p, feed, amount in parts
    ]
    return (
        reduce(DataFrame.unionByName, rows)
        .groupBy(*keys, "feed")
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum("amount").alias("revenue_usd"))
    )


def refund_links(payments: DataFrame) -> DataFrame:
    """Each refund with the payment it names; NULL beside it if there is none.

    Only refunds are on the left, so the many payments that name no other do not meet
    in one task under a NULL key.
    """
    refunds = payments.filter("is_refund").select(
        F.col("payment_id").alias("refund_id"),
        "original_payment_id",
        F.col("amount_usd").alias("refund_usd"),
    )
    originals = payments.filter("NOT is_refund AND payment_id IS NOT NULL").select(
        F.col("payment_id").alias("original_payment_id"),
        F.col("amount_usd").alias("original_usd"),
        F.col("status").alias("original_status"),
    )
    return refunds.join(originals, "original_payment_id", "left")


def events_per_minute(rows: DataFrame) -> DataFrame:
    """Number of events per minute of event time and type; on a stream under its watermark."""
    minute = F.window(EVENT_TIME, "1 minute")
    counts = rows.groupBy(minute, "event_type").agg(F.count(F.lit(1)).alias("n_events"))
    return counts.select(F.col("window.start").alias("minute"), "event_type", "n_events")


def reconcile_invoices(invoices: DataFrame) -> DataFrame:
    """Invoices with the amount their subscriptions make up, and the difference to it."""
    expected = F.col("total_subscriptions") * F.col("revenue_per_sub")
    return invoices.select(
        "invoice_id",
        "partner_name",
        "total_amount_usd",
        expected.alias("expected_usd"),
        F.round(F.col("total_amount_usd") - expected, 2).alias("difference_usd"),
    )


def ad_fill(ads: DataFrame, *keys: str) -> DataFrame:
    """Impressions, billable ones, and revenue per key; ratios follow from these sums."""
    return ads.groupBy(*keys).agg(
        F.sum("impression_count").alias("impressions"),
        F.sum("billable_impressions").alias("billable"),
        F.sum("revenue_usd").alias("revenue_usd"),
    )


def with_ratios(sums: DataFrame) -> DataFrame:
    """Share of billable impressions and revenue per thousand; NULL where none count."""
    return sums.withColumns(
        {
            "fill_rate": F.try_divide("billable", "impressions"),
            "revenue_per_thousand": F.try_divide(F.col("revenue_usd") * 1000, "billable"),
        }
    )


def undecodable(records: DataFrame, rows: DataFrame, payload: str) -> DataFrame:
    """The payloads of decoded rows whose event id is missing; ``rows`` keeps the payload."""
    return rows.filter(F.col("event_id").isNull()).select(
        *(c for c in records.columns if c != payload), F.col(payload).cast("string").alias(payload)
    )
