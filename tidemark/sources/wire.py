"""Wire records: JSON payload plus partition key, routed to shards."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tidemark.functions.scalars import iso_timestamp

PAYLOAD = "data"
PARTITION_KEY = "partition_key"
SHARD = "shard"
WIRE_SCHEMA = f"{PARTITION_KEY} STRING, {PAYLOAD} BINARY"

# The range of shard counts a stream may have.
SHARDS_MIN = 1
SHARDS_MAX = 50


def encode(rows: DataFrame, key: str = "customer_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows as wire records: partition key and UTF-8 JSON object.

    NULL fields are written out, so every payload names every field, and
    timestamps keep their microseconds.
    """
    fields = [
        iso_timestamp(F.col(f.name)).alias(f.name) if f.dataType == TimestampType() else f.name
        for f in rows.schema.fields
        if f.name not in keep
    ]
    payload = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return rows.select(
        *keep, F.col(key).alias(PARTITION_KEY), F.encode(payload, "UTF-8").alias(PAYLOAD)
    )


def shard_of(key: Column, shards: int) -> Column:
    """The shard a partition key belongs to.

    The leading 32 bits of the key's MD5 fall into one of ``shards`` equal ranges.
    """
    if not SHARDS_MIN <= shards <= SHARDS_MAX:
        raise ValueError(f"shards must lie between {SHARDS_MIN} and {SHARDS_MAX}")
    leading = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.shiftright(leading * shards, 32).cast("int")


def route(records: DataFrame, shards: int) -> DataFrame:
    """Add the shard of each record; all records of one key have the same."""
    return records.withColumn(SHARD, shard_of(F.col(PARTITION_KEY), shards))


def together(routed: DataFrame) -> DataFrame:
    """Bring the records of a shard together before they are written.

    The rebalance hint lets AQE merge small shards into one task and cut a large
    one over several, so one key with a third of the traffic is not one task.
    """
    return routed.hint("rebalance", SHARD)


def deliverable(records: DataFrame) -> Column:
    """Whether a record can be sent: it needs a payload and a key to route by."""
    return F.col(PAYLOAD).isNotNull() & F.col(PARTITION_KEY).isNotNull()


def delivery_counts(records: DataFrame, *keys: str) -> DataFrame:
    """Records that can and cannot be sent, per key."""
    sent = deliverable(records)
    return records.groupBy(*keys).agg(
        F.count_if(sent).alias("delivered"), F.count_if(~sent).alias("failed")
    )


def deliver(records: DataFrame, path: str, shards: int) -> dict[str, int]:
    """Append records to a landing folder, one sub-folder per shard.

    Returns how many were delivered and how many could not be. The counts are
    taken while the records are written; a task that is run again after a lost
    executor may be counted again, so they are for monitoring.
    """
    counts = Observation("delivery")
    sent = deliverable(records)
    observed = records.observe(
        counts, F.count_if(sent).alias("delivered"), F.count_if(~sent).alias("failed")
    )
    (
        together(route(observed.filter(sent), shards))
        .write.mode("append")
        .option("compression", "zstd")
        .partitionBy(SHARD)
        .parquet(path)
    )
    return {name: counts.get[name] for name in ("delivered", "failed")}
