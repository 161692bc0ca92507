"""From raw stream records to typed event rows."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.scalars import moment

EVENT_TIME = "event_timestamp"
INGEST_TIME = "ingestion_timestamp"
INGEST_DATE = "ingestion_date"


def fields_of(schema: StructType, names: Sequence[str]) -> StructType:
    """The part of a schema that a query reads; a payload is parsed for no other field."""
    unknown = set(names) - set(schema.names)
    if unknown:
        raise ValueError(f"no fields of the schema: {', '.join(sorted(unknown))}")
    return StructType([f for f in schema.fields if f.name in names])


def parse_payload(
    records: DataFrame, schema: StructType, payload: str = "data", keep: Sequence[str] = ()
) -> DataFrame:
    """Parse the JSON payload and lift its fields to columns.

    Only the fields survive, plus the record columns named in ``keep``. A
    payload that is no JSON object gives a row of NULLs, and a field of the
    wrong type gives NULL in that field alone; no row is dropped here.

    The fields are lifted by ``inline``: the optimizer moves no later filter
    below it, where the filter would need to parse every payload a second time.
    """
    event = F.from_json(F.col(payload).cast("string"), schema)
    return records.select(*keep, F.inline(F.array(event)))


def parse_event_time(rows: DataFrame) -> DataFrame:
    """Turn the ISO event time into a timestamp, in place, where there is one.

    Text that is no time becomes NULL; it must not stop a running stream.
    """
    if EVENT_TIME not in rows.columns:
        return rows
    return rows.withColumn(EVENT_TIME, F.try_to_timestamp(F.col(EVENT_TIME)))


def stamp(rows: DataFrame, ingested_at: datetime | None = None) -> DataFrame:
    """Append ingest time and ingest date as the last two columns.

    On a stream the clock is read once per micro-batch and kept in the offset
    log, so a replayed batch gets the same stamp. Batch jobs that may be retried
    pass ``ingested_at`` and get that same guarantee.
    """
    now = F.current_timestamp() if ingested_at is None else moment(ingested_at)
    return rows.withColumns({INGEST_TIME: now, INGEST_DATE: now.cast("date")})


def decode(
    records: DataFrame,
    schema: StructType,
    payload: str = "data",
    ingested_at: datetime | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse, time and stamp records; the same call serves batch and stream."""
    return stamp(parse_event_time(parse_payload(records, schema, payload, keep)), ingested_at)
