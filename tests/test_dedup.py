from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators.decode import decode, fields_of
from tidemark.operators.dedup import among, dedup_batch, without_stored
from tidemark.schemas import get_schema
from tidemark.sources.wire import WIRE_SCHEMA


def test_one_row_per_id_nulls_equal(spark):
    frame = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "x"), ("b", 2, None), (None, 3, "y"), (None, 4, "z")],
        "event_id STRING, n INT, t STRING",
    ).repartition(3)
    kept = dedup_batch(frame)
    assert kept.columns == frame.columns
    assert kept.schema == frame.schema
    rows = kept.collect()
    assert Counter(r["event_id"] for r in rows) == {"a": 1, "b": 1, None: 1}
    assert set(map(tuple, rows)) <= set(map(tuple, frame.collect()))


def test_survivor_is_one_whole_row(spark):
    """No mixing of columns of different copies, NULLs included."""
    frame = spark.range(2000).select(
        (F.col("id") % 7).cast("string").alias("event_id"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("x"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("y"),
    )
    for row in dedup_batch(frame).collect():
        assert row["x"] == row["y"]


def test_only_the_key(spark):
    frame = spark.createDataFrame([("a",), ("a",), (None,)], "event_id STRING")
    assert dedup_batch(frame).count() == 2


def test_within(spark):
    frame = spark.createDataFrame(
        [(1, "a", 0), (2, "a", 0), (2, "a", 0)], "batch INT, event_id STRING, v INT"
    )
    assert sorted(r["batch"] for r in dedup_batch(frame, within=("batch",)).collect()) == [1, 2]


def test_copies_fold_before_the_shuffle(spark):
    """An id with most of the rows sends one row per map task through the shuffle."""
    frame = spark.range(100).select(F.lit("hot").alias("event_id"), F.col("id").alias("v"))
    plan = dedup_batch(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "partial_min_by" in below and "partial_min_by" not in above


def test_survivor_is_the_same_in_every_run(spark):
    """Of copies that differ the earliest stays, then the one with the smallest hash."""
    rows = [("a", 5, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "p"), ("b", 1, "q")]
    frame = spark.createDataFrame(rows, "event_id STRING, event_timestamp INT, t STRING")
    kept = [sorted(map(tuple, dedup_batch(frame.repartition(n)).collect())) for n in (1, 2, 5)]
    assert kept[0] == kept[1] == kept[2]
    assert kept[0][0][:2] == ("a", 3) and kept[0][1] == ("b", None, "p")
    by_text = dedup_batch(frame, first_by=("t",)).collect()
    assert sorted(r["t"] for r in by_text) == ["p", "x"]


def test_only_what_is_selected_travels(spark):
    schema = fields_of(get_schema("subscription_payment"), ("event_id", "status", "amount_usd"))
    records = spark.createDataFrame([("k", b'{"event_id":"a","status":"s"}')], WIRE_SCHEMA)
    rows = decode(records, schema).select("event_id", "status", "amount_usd")
    plan = dedup_batch(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "StructField(status" in plan
    assert "user_id" not in plan and "ingestion" not in plan
    assert dedup_batch(rows).collect() == [("a", "s", None)]
    with pytest.raises(ValueError, match="nothing"):
        fields_of(schema, ["nothing"])


def test_without_stored(spark):
    rows = spark.createDataFrame([(n, f"e{n}" if n % 5 else None) for n in range(50)], "n INT, event_id STRING")
    held = spark.createDataFrame([(f"e{n}",) for n in range(0, 50, 3)] + [(None,)], "event_id STRING")
    found = without_stored(rows, held)
    want = sorted(n for n in range(50) if n % 5 == 0 or n % 3)
    assert sorted(r["n"] for r in found.collect()) == want
    assert found.columns == rows.columns
    assert without_stored(rows, held.limit(0)).count() == 50
    assert without_stored(rows.limit(0), held).count() == 0


def test_filter_keeps_all_that_match_and_few_others(spark):
    ids = spark.range(1000).select(F.concat(F.lit("e"), "id").alias("event_id"))
    rows = spark.range(200_000).select(F.concat(F.lit("e"), F.col("id") + 500).alias("event_id"))
    found = {r["event_id"] for r in among(rows, ids).collect()}
    assert found >= {f"e{n}" for n in range(500, 1000)}
    assert len(found) < 600
