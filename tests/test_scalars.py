import math
import random
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.scalars import (
    billing_period,
    draw,
    iso_timestamp,
    lookup,
    pick,
)


def test_draws_are_uniform_and_independent(spark):
    rows = spark.range(40_000).select(
        draw(F.col("id"), 1, 10).alias("a"), draw(F.col("id"), 2, 4).alias("b")
    )
    cells = {(r["a"], r["b"]): r["count"] for r in rows.groupBy("a", "b").count().collect()}
    assert len(cells) == 40
    chi2 = sum((n - 1000) ** 2 / 1000 for n in cells.values())
    assert chi2 < 75  # 39 degrees of freedom; 1 in 2000 random tables exceeds it


def test_draws_of_huge_and_negative_ids(spark):
    ids = [2**62, 2**62 + 1, 2**31 - 1, 2**31, 0, -1, -(2**40)]
    rows = spark.createDataFrame([(i,) for i in ids], "id BIGINT")
    found = [r[0] for r in rows.select(draw(F.col("id"), 3, 1000)).collect()]
    assert all(0 <= v < 1000 for v in found) and len(set(found)) > 4


def test_small_functions(spark):
    at = F.lit("2024-02-29 01:02:03.000004").cast("timestamp")
    row = spark.range(1).select(
        iso_timestamp(at),
        billing_period(at),
        lookup(F.lit("b"), {"a": 1.0, "b": 2.5}),
        lookup(F.lit("z"), {"a": 1.0}),
        pick(F.col("id"), 1, ["only"]),
    ).first()
    assert tuple(row) == ("2024-02-29T01:02:03.000004+00:00", "2024-02", 2.5, None, "only")
