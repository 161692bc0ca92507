"""Wire schemas of the three event feeds and their registry."""

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

TEXT, MONEY, COUNT, FLAG = StringType(), DoubleType(), IntegerType(), BooleanType()

# Names, types and order of the fields in each wire format.
# event_timestamp travels as ISO-8601 text and becomes a timestamp on decode.
WIRE_FIELDS: dict[str, dict[str, DataType]] = {
    "subscription_payment": {
        "event_id": TEXT,
        "event_type": TEXT,
        "event_timestamp": TEXT,
        "payment_id": TEXT,
        "customer_id": TEXT,
        "user_id": TEXT,
        "subscription_id": TEXT,
        "amount_usd": MONEY,
        "currency": TEXT,
        "status": TEXT,
        "subscription_tier": TEXT,
        "country_code": TEXT,
        "payment_processor": TEXT,
        "billing_period": TEXT,
        "is_refund": FLAG,
        "original_payment_id": TEXT,
    },
    "partner_invoice": {
        "event_id": TEXT,
        "event_type": TEXT,
        "event_timestamp": TEXT,
        "invoice_id": TEXT,
        "partner_name": TEXT,
        "billing_period": TEXT,
        "total_subscriptions": COUNT,
        "revenue_per_sub": MONEY,
        "total_amount_usd": MONEY,
        "status": TEXT,
        "paid_date": TEXT,
        "country_code": TEXT,
    },
    "ad_revenue": {
        "event_id": TEXT,
        "event_type": TEXT,
        "event_timestamp": TEXT,
        "advertiser_name": TEXT,
        "country_code": TEXT,
        "impression_count": COUNT,
        "billable_impressions": COUNT,
        "revenue_usd": MONEY,
        "billing_period": TEXT,
    },
}


def get_schema(name: str) -> StructType:
    """The wire schema registered as ``name``; every field is nullable."""
    fields = WIRE_FIELDS.get(name)
    if fields is None:
        raise ValueError(f"unknown schema {name!r}; known schemas: {', '.join(WIRE_FIELDS)}")
    return StructType([StructField(field, kind, True) for field, kind in fields.items()])
