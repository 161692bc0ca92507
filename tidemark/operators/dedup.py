"""Removal of redelivered events."""

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.decode import EVENT_TIME, INGEST_TIME

EVENT_KEY = "event_id"
NULL_MARK = "_null_in"


def dedup_batch(
    rows: DataFrame,
    within: Sequence[str] = (),
    copies: str = "",
    first_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per event id, among the rows at hand.

    Copies fold on the map side before the shuffle, so an id that makes up a
    large share of the input reaches the final task as one row per map task.
    NULL ids count as equal: undecodable rows fold to one. Of copies that differ, the one
    that is smallest in ``first_by`` stays (by default the event time where there is one,
    NULL first), then the one with the smallest hash: a batch that is run again keeps the
    same. ``within`` limits the comparison to rows equal in it; ``copies`` names a column to
    add with the number of rows that each one stands for.

    The other columns are packed in one struct: one aggregate buffer in place of one per
    column halves the time of the sorts. Rows are as wide as the caller leaves them, so
    select what is needed first.
    """
    keys = [*within, EVENT_KEY]
    others = [c for c in rows.columns if c not in keys]
    if not others and not copies:
        return rows.dropDuplicates(keys)
    if first_by is None:
        first_by = [c for c in (EVENT_TIME,) if c in others]
    packed = F.struct(*others)
    kept = [F.min_by(packed, F.struct(*first_by, F.xxhash64(*others))).alias("kept")] if others else []
    number = [F.count(F.lit(1)).alias(copies)] if copies else []
    folded = rows.groupBy(*keys).agg(*kept, *number)
    unpacked = folded.select("*", "kept.*") if others else folded
    return unpacked.select(*rows.columns, *([copies] if copies else []))


# Places of the filter over the ids of a batch, and how many of them a row of it holds.
FILTER_PLACES = 1 << 27
BUCKET_PLACES = 32_768


def _place(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_PLACES))


def among(rows: DataFrame, ids: DataFrame, key: str = EVENT_KEY) -> DataFrame:
    """The rows whose key may be in ``ids``: all that are, and few others.

    A Bloom filter of one hash, built of bitmaps: at most 4,096 of them with 4 KB each, so
    16 MB are broadcast however many ids there are.
    """
    place = _place(key)
    bitmaps = (
        ids.filter(F.col(key).isNotNull())
        .select(place.alias("place"))
        .groupBy(F.floor(F.col("place") / BUCKET_PLACES).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("place") % BUCKET_PLACES).alias("bits"))
    )
    bit = (place % BUCKET_PLACES).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    held = byte.cast("int").bitwiseAND(F.pow(2, bit % 8).cast("int"))
    bucketed = rows.withColumn("bucket", F.floor(place / BUCKET_PLACES))
    return bucketed.join(F.broadcast(bitmaps), "bucket").filter(held != 0).drop("bucket", "bits")


def without_stored(rows: DataFrame, stored: DataFrame, key: str = EVENT_KEY) -> DataFrame:
    """The rows whose key is not among the stored ones; rows without a key stay.

    ``rows`` bear each key once, as ``dedup_batch`` leaves them, so no key is hot in the
    join, which goes by the partitioning of that aggregate. Of the stored ids only those
    that may match reach it.
    """
    found = among(stored.select(key), rows.select(key), key)
    return rows.join(found, key, "left_anti").select(rows.columns)


def copy_folder(key: str = EVENT_KEY) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A function that keeps the first row of each key in every Arrow batch.

    It is made here, not defined at module level, so that it travels to the
    executors by value and they need not have this package installed.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(key).dictionary_encode(null_encoding="encode")
            _, first = np.unique(ids.indices.to_numpy(), return_index=True)
            yield batch if len(first) == len(batch) else batch.take(pa.array(first))

    return fold


def dedup_across(rows: DataFrame, delay: str, time: str = INGEST_TIME) -> DataFrame:
    """One row per event id across the micro-batches of a stream.

    An id is remembered for ``delay`` after its first copy, so state is bounded
    by the traffic of one ``delay``, which must exceed the longest redelivery
    gap. By ingest time no row is ever late and none is left out. By event time
    a long backlog needs less state, but rows older than the watermark (largest
    event time seen, less ``delay``) count as late and are left out, the
    progress reports their number, and rows without event time are compared
    within their batch only. NULL ids are equal within a batch, as they are in
    ``dedup_batch``.

    The stateful operator takes every row through its shuffle unfolded, and a
    stream allows no plain aggregate before it. So copies are first folded
    inside each map task, in Arrow batches: an id that makes up a third of the
    input, or a flood of undecodable rows, does not end up in one state task.
    """
    folded = rows.mapInArrow(copy_folder(), rows.schema)
    batch_of_null = F.when(F.col(EVENT_KEY).isNull(), F.col(INGEST_TIME))
    keyed = folded.withColumn(NULL_MARK, batch_of_null).withWatermark(time, delay)
    return keyed.dropDuplicatesWithinWatermark([EVENT_KEY, NULL_MARK]).drop(NULL_MARK)
