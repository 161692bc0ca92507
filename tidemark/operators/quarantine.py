"""Telling records that do not decode from events, and why they do not."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import EVENT_KEY

PAYLOAD_TEXT = "payload"
CAUSE = "cause"
N_RECORDS = "n_records"

NO_PAYLOAD = "no payload"
EMPTY = "empty"
NOT_JSON = "not JSON"
NO_OBJECT = "no object"
NO_EVENT_ID = "no event id"


def cause_of(payload: Column) -> Column:
    """Why the text of a record gives no event."""
    parsed = F.try_parse_json(payload)
    return (
        F.when(payload.isNull(), NO_PAYLOAD)
        .when(F.trim(payload) == "", EMPTY)
        .when(parsed.isNull(), NOT_JSON)
        .when(~F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")), NO_OBJECT)
        .otherwise(NO_EVENT_ID)
    )


def mark_undecodable(rows: DataFrame, payload: str) -> DataFrame:
    """Decoded rows with the text and cause of those without an event id, in place of ``payload``.

    Only for these is the payload looked at again; both columns are NULL for events.
    """
    text = F.col(payload).cast("string")
    lost = F.col(EVENT_KEY).isNull()
    others = [c for c in rows.columns if c != payload]
    return rows.select(
        *others,
        F.when(lost, text).alias(PAYLOAD_TEXT),
        F.when(lost, cause_of(text)).alias(CAUSE),
    )
