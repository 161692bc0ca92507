import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.decode import decode, parse_payload
from tidemark.schemas import WIRE_FIELDS, get_schema

PROBE = "event_id STRING, event_timestamp STRING, amount_usd DOUBLE, n INT, is_refund BOOLEAN"
NULLS = (None, None, None, None, None)
NOON = datetime(2024, 3, 1, 12)


def timed(text):
    return json.dumps({"event_id": "e", "event_timestamp": text})


CASES = [
    (
        '{"event_id":"e","event_timestamp":"2024-03-01T12:00:00+00:00",'
        '"amount_usd":9.99,"n":7,"is_refund":true}',
        ("e", NOON, 9.99, 7, True),
    ),
    ('{"event_id":"e","amount_usd":15,"n":3.7}', ("e", None, 15.0, None, None)),
    ('{"event_id":"e","amount_usd":"abc","n":"7","is_refund":"true"}', ("e",) + NULLS[1:]),
    ("not json", NULLS),
    ("null", NULLS),
    ("[]", NULLS),
    ("{}", NULLS),
    ("", NULLS),
    (None, NULLS),
    ('{"event_id":"e","amount_usd":', NULLS),
    ('[{"event_id":"a"},{"event_id":"b"}]', NULLS),
    ('{"event_id":"e","extra":{"x":1}}', ("e",) + NULLS[1:]),
    ('{"event_id":5}', ("5",) + NULLS[1:]),
    ('{"event_id":{"x":1}}', ('{"x":1}',) + NULLS[1:]),
    ('{"event_id":"e","n":3000000000}', ("e",) + NULLS[1:]),
    ('{"event_id":"a","event_id":"b"}', ("b",) + NULLS[1:]),
    ('{"EVENT_ID":"e"}', NULLS),
    (timed("2024-03-01"), ("e", datetime(2024, 3, 1)) + NULLS[2:]),
    (timed("2024-03-01T17:00:00+05:00"), ("e", NOON) + NULLS[2:]),
    (
        timed("2024-03-01T12:00:00.123456+00:00"),
        ("e", NOON.replace(microsecond=123456)) + NULLS[2:],
    ),
    (timed("soon"), ("e",) + NULLS[1:]),
    (timed(""), ("e",) + NULLS[1:]),
]


def probe_schema():
    return StructType.fromDDL(PROBE)


def test_payloads(spark):
    records = spark.createDataFrame(
        [(i, None if p is None else p.encode()) for i, (p, _) in enumerate(CASES)], "i INT, data BINARY"
    )
    rows = decode(records, probe_schema(), keep=("i",)).withColumn(
        "event_timestamp", F.col("event_timestamp").cast("timestamp_ntz")
    )
    found = {r["i"]: tuple(r)[1:6] for r in rows.collect()}
    assert found == {i: want for i, (_, want) in enumerate(CASES)}


def test_text_payload_of_another_name(spark):
    records = spark.createDataFrame([('{"event_id":"e"}',)], "value STRING")
    assert decode(records, probe_schema(), "value").first()["event_id"] == "e"


def test_schema_without_event_time(spark):
    schema = StructType([StructField("event_id", StringType())])
    records = spark.createDataFrame([('{"event_id":"e"}',)], "data STRING")
    assert decode(records, schema).columns == ["event_id", "ingestion_timestamp", "ingestion_date"]


def test_stamp_is_the_given_moment(spark):
    records = spark.createDataFrame([('{"event_id":"e"}',)], "data STRING")
    rows = decode(records, probe_schema(), ingested_at=datetime(2024, 5, 6, 7, 8))
    row = rows.select(
        F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm").alias("at"), "ingestion_date"
    ).first()
    assert tuple(row) == ("2024-05-06 07:08", date(2024, 5, 6))


def test_stamp_is_now(spark):
    records = spark.range(3).select(F.lit("{}").alias("data"))
    rows = decode(records, probe_schema())
    age = rows.select(
        F.max(F.unix_seconds(F.current_timestamp()) - F.unix_seconds("ingestion_timestamp")),
        F.count_distinct("ingestion_timestamp"),
        F.bool_and(F.col("ingestion_date") == F.col("ingestion_timestamp").cast("date")),
    ).first()
    assert age[0] < 60 and age[1] == 1 and age[2]


@pytest.mark.parametrize(
    "name,width", [("subscription_payment", 18), ("partner_invoice", 14), ("ad_revenue", 11)]
)
def test_table_width(spark, name, width):
    records = spark.createDataFrame([("{}",)], "data STRING")
    rows = decode(records, get_schema(name))
    assert len(rows.columns) == width
    assert rows.columns == list(WIRE_FIELDS[name]) + ["ingestion_timestamp", "ingestion_date"]
    kinds = dict(rows.dtypes)
    assert kinds["event_timestamp"] == "timestamp"
    assert kinds.get("paid_date", "string") == "string"


def test_unknown_schema_names_the_known():
    with pytest.raises(ValueError, match="'x'.*subscription_payment, partner_invoice, ad_revenue"):
        get_schema("x")


def test_schemas_are_nullable():
    for name in WIRE_FIELDS:
        assert all(f.nullable for f in get_schema(name).fields)


def test_filter_does_not_parse_twice(spark):
    records = spark.createDataFrame([(json.dumps({"event_id": "e"}),)], "data STRING")
    rows = parse_payload(records, probe_schema()).filter("n > 3 and event_id = 'e'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
