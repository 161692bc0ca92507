"""Event tables: creation, replay-safe writes, reads and upkeep.

A table is partitioned by ingest date, stream and micro-batch, and a micro-batch owns
exactly one partition. Every attempt to store it writes a folder of its own; one catalog
statement then makes that folder the partition. So a batch that is run again after a
failure is stored once, a write that fails leaves what was there, a reader finds either
attempt whole, and loaders that run side by side share neither a folder nor a session
setting. ``_stream`` is the id of the streaming query, which keeps the batch numbers of
different checkpoints apart.

Beside each table lies the list of its batches, a table that is written in the same way:
what each batch brought, and the folder it is in. Reads as of a batch and reports come
from there, and a new catalog finds the partitions by it.
"""

import json
import logging
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.functions.scalars import moment
from tidemark.operators.decode import EVENT_TIME, INGEST_DATE, INGEST_TIME
from tidemark.operators.dedup import EVENT_KEY
from tidemark.operators.quarantine import CAUSE, N_RECORDS, PAYLOAD_TEXT
from tidemark.operators.revenue import latency_ms

STREAM = "_stream"
BATCH = "_batch_id"
BOOKKEEPING = (STREAM, BATCH)
PARTITIONS = {INGEST_DATE: "DATE", STREAM: "STRING", BATCH: "BIGINT"}

# The codec of the data files, and where a table format expects its name.
CODEC = "zstd"
CODEC_PROPERTY = "write.parquet.compression-codec"
# Providers whose partitions are folders of files; others replace rows by themselves.
FILE_PROVIDERS = ("parquet", "orc")
ATTEMPTS = "attempts"
# Tells the undecodable records of an attempt from the events.
LOST = "_undecodable"
# A view over closed days names its live table in this property.
LIVE_TABLE = "tidemark.live"
BATCHES = "__batches"
# What a batch brought; ``latency`` is a KLL sketch of milliseconds from event to ingest.
REPORT = {
    "stream": "STRING",
    "batch_id": "BIGINT",
    INGEST_DATE: "DATE",
    INGEST_TIME: "TIMESTAMP",
    "received": "BIGINT",
    "undecodable": "BIGINT",
    "stored": "BIGINT",
    "latency": "BINARY",
    "folder": "STRING",
    "written_at": "TIMESTAMP",
}
# Partitions that are named in one statement.
AT_ONCE = 200
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class TableSpec:
    """Where a table lives and how it is made when it does not exist yet."""

    name: str
    provider: str = "parquet"
    location: str | None = None
    evolve: bool = False


def columns_ddl(fields: Iterable[StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_spec(ingestion_date: date | str, _stream: str, _batch_id: int | str) -> str:
    """The partition of one micro-batch, as SQL; arguments are named like its columns."""
    return f"{INGEST_DATE} = DATE'{ingestion_date}', {batch_spec(_stream, _batch_id)}"


def batch_spec(_stream: str, _batch_id: int | str) -> str:
    """The partition of one micro-batch in the list of batches, as SQL."""
    return f"{STREAM} = {_text(_stream)}, {BATCH} = {int(_batch_id)}"


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{place}")


def add_table(
    spark: SparkSession, target: TableSpec, columns: str, keys: Iterable[str]
) -> None:
    """Create a partitioned table unless it is there, with the codec of its provider."""
    place = f" LOCATION {_text(target.location)}" if target.location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(target.name)} ({columns}) "
        f"USING {target.provider} OPTIONS (compression '{CODEC}') "
        f"PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)}){place} "
        f"TBLPROPERTIES ('{CODEC_PROPERTY}' = '{CODEC}')"
    )


def list_of(target: TableSpec) -> TableSpec:
    """The list of the batches of a table."""
    place = target.location and f"{target.location.rstrip('/')}{BATCHES}"
    return TableSpec(target.name + BATCHES, location=place)


def create_table(spark: SparkSession, target: TableSpec, schema: StructType) -> None:
    """Create the table for rows of ``schema`` and its list of batches unless they are there.

    At an explicit ``location`` the batches that were stored under an earlier catalog
    are found by their list and registered again.
    """
    data = [f for f in schema.fields if f.name not in PARTITIONS]
    add_table(spark, target, f"{columns_ddl(data)}, {_ddl(PARTITIONS)}", PARTITIONS)
    listed = list_of(target)
    keys = {k: PARTITIONS[k] for k in BOOKKEEPING}
    add_table(spark, listed, _ddl(REPORT | keys), BOOKKEEPING)
    if target.location:
        _recover(spark, target.name, listed)


def _recover(spark: SparkSession, table: str, listed: TableSpec) -> None:
    """Register the batches of a list whose catalog is gone; the last attempt of each counts."""
    # Writing nothing makes sure that there is a folder to look through.
    nothing = spark.range(0, 0, 1, 1).select(*_values([None] * len(REPORT)))
    nothing.write.parquet(_attempt(listed.location))
    files = spark.read.schema(_ddl(REPORT)).option("recursiveFileLookup", True)
    place = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("place")
    rows = files.parquet(f"{listed.location}/{ATTEMPTS}").select("*", place)
    last = {}
    for row in rows.orderBy("written_at").collect():
        last[row["stream"], row["batch_id"]] = row
    batches = list(last.values())
    for at in range(0, len(batches), AT_ONCE):
        some = batches[at : at + AT_ONCE]
        specs = [(partition_spec(r[INGEST_DATE], r["stream"], r["batch_id"]), r["folder"]) for r in some]
        _add_partitions(spark, table, specs)
        specs = [(batch_spec(r["stream"], r["batch_id"]), r["place"]) for r in some]
        _add_partitions(spark, listed.name, specs)


def _ddl(columns: Mapping[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


def _values(values: Sequence[Any]) -> list[Column]:
    """The values of one entry of a list of batches, as literals."""
    return [F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(values, REPORT.items())]


def _add_partitions(spark: SparkSession, table: str, places: Sequence[tuple[str, str]]) -> None:
    """Register folders as partitions, but for those that are registered already."""
    parts = " ".join(f"PARTITION ({spec}) LOCATION {_text(folder)}" for spec, folder in places)
    spark.sql(f"ALTER TABLE {quoted(table)} ADD IF NOT EXISTS {parts}")


def put_in_place(spark: SparkSession, table: str, spec: str, folder: str) -> None:
    """Make a folder the content of a partition, in one step for those who read it."""
    _add_partitions(spark, table, [(spec, folder)])
    spark.sql(f"ALTER TABLE {quoted(table)} PARTITION ({spec}) SET LOCATION {_text(folder)}")


def folder_of(spark: SparkSession, table: str) -> str:
    """The folder of a table, as its catalog has it."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)} AS JSON").head()[0]
    return json.loads(described)["location"]


def _attempt(folder: str) -> str:
    return f"{folder.rstrip('/')}/{ATTEMPTS}/{uuid.uuid4().hex}"


def write_attempt(spark: SparkSession, target: TableSpec, rows: DataFrame, *keys: str) -> str:
    """Write the rows to a fresh folder of the table that no reader knows of yet."""
    folder = _attempt(folder_of(spark, target.name))
    writer = rows.write.format(target.provider).option("compression", CODEC)
    (writer.partitionBy(*keys) if keys else writer).save(folder)
    return folder


def add_columns(spark: SparkSession, table: str, fields: Iterable[StructField]) -> None:
    """Add columns to a table; rows already stored read NULL in them."""
    spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({columns_ddl(fields)})")


def fitted_columns(spark: SparkSession, target: TableSpec, rows: DataFrame) -> list[Column]:
    """The data columns of ``rows`` in the order of the table.

    A column the rows lack is filled with NULL. A column the table lacks is
    added to it if ``target.evolve`` and is an error otherwise, as is a column of
    another type.
    """
    table = target.name
    stored = {f.name: f.dataType for f in spark.table(quoted(table)).schema.fields}
    given = {f.name: f for f in rows.schema.fields if f.name not in PARTITIONS}
    wrong = [n for n, f in given.items() if n in stored and stored[n] != f.dataType]
    if wrong:
        raise ValueError(f"types differ from table {table}: {', '.join(wrong)}")
    new = [f for n, f in given.items() if n not in stored]
    if new and not target.evolve:
        raise ValueError(f"not in table {table}: {', '.join(f.name for f in new)}")
    if new:
        add_columns(spark, table, new)
        stored |= {f.name: f.dataType for f in new}
    return [
        F.col(name) if name in given else F.lit(None).cast(kind).alias(name)
        for name, kind in stored.items()
        if name not in PARTITIONS
    ]


@dataclass(frozen=True)
class BatchReport:
    """What one micro-batch brought to a table.

    Where ids are compared across batches, copies are gone before they reach it. All is
    counted in the tasks that write, so a task run again is counted once.
    """

    batch_id: int
    received: int
    undecodable: int
    stored: int


def _counts(columns: Sequence[str], copies: str) -> list[Column]:
    """What is counted of a batch while it is written."""
    number = F.col(copies) if copies else F.lit(1)
    lost = F.when(F.col(EVENT_KEY).isNull(), number) if EVENT_KEY in columns else F.lit(0)
    timed = EVENT_TIME in columns
    latency = F.kll_sketch_agg_bigint(latency_ms()) if timed else F.lit(None).cast("binary")
    return [
        F.coalesce(F.sum(number), F.lit(0)).alias("received"),
        F.coalesce(F.sum(lost), F.lit(0)).alias("undecodable"),
        F.count(F.lit(1)).alias("stored"),
        F.count_if(F.col(EVENT_KEY).isNull() if EVENT_KEY in columns else F.lit(False)).alias("lost"),
        F.count(INGEST_DATE).alias("dated"),
        F.min(INGEST_DATE).alias("day"),
        F.max(INGEST_DATE).alias("last_day"),
        F.max(INGEST_TIME).alias("ingested_at"),
        (latency if timed else F.max(latency)).alias("latency"),
    ]


def store_batch(
    spark: SparkSession,
    target: TableSpec,
    rows: DataFrame,
    stream: str,
    batch_id: int,
    copies: str = "",
) -> BatchReport | None:
    """Store ``rows`` as the whole content of one micro-batch; None if there are none.

    The table is created if it is not there yet, but not by an empty batch. All rows must
    bear one ingest date; rows of several belong in several batches. ``copies`` names a
    column, not stored, with the number of records that each row stands for. Nothing is
    changed for readers until all is written and counted.
    """
    events = rows.drop(copies)
    if not _ready(spark, rows, {target: events.schema}):
        return None
    seen = Observation()
    counted = rows.observe(seen, *_counts(rows.columns, copies))
    fitted = counted.select(*fitted_columns(spark, target, events))
    folder = write_attempt(spark, target, fitted)
    found = seen.get
    if not found["stored"]:
        return None
    day = _one_day(found)
    put_in_place(spark, target.name, partition_spec(day, stream, batch_id), folder)
    _list_batch(spark, target, found, stream, batch_id, folder)
    return _report(batch_id, found)


def store_split_batch(
    spark: SparkSession,
    target: TableSpec,
    quarantine: TableSpec,
    rows: DataFrame,
    stream: str,
    batch_id: int,
    copies: str,
    between: Callable[[int], None] | None = None,
) -> BatchReport | None:
    """Store the events of a batch in one table and its undecodable records in another.

    ``rows`` are marked (``mark_undecodable``). One job writes both to one attempt; then
    each part is put in place, the records first. A crash in between (``between`` is called
    there) leaves the batch uncommitted, and the next attempt puts both in place anew.
    """
    events = rows.drop(copies, PAYLOAD_TEXT, CAUSE)
    records = rows.select(
        PAYLOAD_TEXT, CAUSE, F.col(copies).alias(N_RECORDS), INGEST_TIME, INGEST_DATE
    )
    if not _ready(spark, rows, {target: events.schema, quarantine: records.schema}):
        return None
    seen = Observation()
    counted = rows.observe(seen, *_counts(rows.columns, copies))
    columns = fitted_columns(spark, target, events)
    lost = F.col(EVENT_KEY).isNull().alias(LOST)
    parts = counted.select(*columns, PAYLOAD_TEXT, CAUSE, F.col(copies).alias(N_RECORDS), lost)
    folder = write_attempt(spark, target, parts, LOST)
    found = seen.get
    if not found["stored"]:
        return None
    day = _one_day(found)
    kept = found["stored"] - found["lost"]
    for table, n, value in ((quarantine, found["lost"], "true"), (target, kept, "false")):
        spec = partition_spec(day, stream, batch_id)
        place = f"{folder}/{LOST}={value}"
        if n:
            put_in_place(spark, table.name, spec, place)
        else:
            spark.sql(f"ALTER TABLE {quoted(table.name)} DROP IF EXISTS PARTITION ({spec})")
        _list_batch(spark, table, {**found, "stored": n}, stream, batch_id, place)
        if between and table is quarantine:
            between(batch_id)
    return _report(batch_id, {**found, "stored": kept})


def _ready(spark: SparkSession, rows: DataFrame, schemas: Mapping[TableSpec, StructType]) -> bool:
    """Make the tables that are missing; False if that would be for an empty batch."""
    for target, schema in schemas.items():
        if target.provider not in FILE_PROVIDERS:
            raise ValueError(f"no way to replace partitions of {target.provider} tables")
        if spark.catalog.tableExists(target.name):
            continue
        if rows.isEmpty():
            return False
        log.info("creating table %s", target.name)
        create_table(spark, target, schema)
    return True


def _report(batch_id: int, found: Mapping[str, Any]) -> BatchReport:
    return BatchReport(batch_id, found["received"], found["undecodable"], found["stored"])


def _one_day(found: Mapping[str, Any]) -> date:
    if found["dated"] < found["stored"]:
        raise ValueError("a row of the batch bears no ingest date")
    if found["day"] != found["last_day"]:
        raise ValueError(f"ingest dates {found['day']} and {found['last_day']} in one batch")
    return found["day"]


def _list_batch(
    spark: SparkSession,
    target: TableSpec,
    found: Mapping[str, Any],
    stream: str,
    batch_id: int,
    folder: str,
) -> None:
    listed = list_of(target)
    now = datetime.now(timezone.utc)
    values = (
        *(stream, batch_id, found["day"], found["ingested_at"]),
        *(found["received"], found["undecodable"], found["stored"]),
        found["latency"] and bytes(found["latency"]),
        *(folder, now),
    )
    row = spark.range(0, 1, 1, 1).select(*_values(values))
    put_in_place(spark, listed.name, batch_spec(stream, batch_id), write_attempt(spark, listed, row))


def batch_list(spark: SparkSession, table: str) -> DataFrame:
    """What each stored batch of a table brought, one row per batch."""
    return current(spark, table + BATCHES).drop(*BOOKKEEPING)


def current(spark: SparkSession, table: str) -> DataFrame:
    """All columns of a table, from the folders its partitions have now.

    A session may remember them. A replayed batch has another, put in place in the session
    of its stream, so the memory of this one is dropped.
    """
    spark.catalog.refreshTable(quoted(table))
    return spark.table(quoted(table))


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table without its bookkeeping columns."""
    return current(spark, table).drop(*BOOKKEEPING)


def _has_one_stream(spark: SparkSession, table: str) -> bool:
    """Whether the batches of a table, or of the live table of a view, are of one stream.

    The catalog tells: no file is opened.
    """
    properties = spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").filter(F.col("key") == LIVE_TABLE)
    live = properties.head()
    name = F.regexp_extract("partition", f"{STREAM}=([^/]+)", 1)
    listed = quoted((live["value"] if live else table) + BATCHES)
    return spark.sql(f"SHOW PARTITIONS {listed}").select(name).distinct().count() <= 1


def as_of_batch(
    spark: SparkSession, table: str, batch_id: int, stream: str | None = None
) -> DataFrame:
    """The table as it was right after a micro-batch; reads only older partitions.

    Batch numbers of different streams do not compare, so ``stream`` must be named if
    the table has more than one.
    """
    rows = current(spark, table)
    if stream is not None:
        rows = rows.filter(F.col(STREAM) == stream)
    elif not _has_one_stream(spark, table):
        raise ValueError(f"{table} has batches of several streams, name one")
    return rows.filter(F.col(BATCH) <= batch_id).drop(*BOOKKEEPING)


def ids_of_days(
    spark: SparkSession, table: str, day: date, days: int, stream: str, batch_id: int
) -> DataFrame | None:
    """The event ids stored on a day and the ``days`` before it, but for those of one batch.

    None if there is no table yet. Reads the ids alone, of these days alone.
    """
    if not spark.catalog.tableExists(table):
        return None
    recent = F.col(INGEST_DATE).between(F.lit(day - timedelta(days=days)), F.lit(day))
    own = (F.col(STREAM) == stream) & (F.col(BATCH) == batch_id)
    return current(spark, table).filter(recent & ~own).select(EVENT_KEY)


def as_of_time(spark: SparkSession, table: str, at: datetime) -> DataFrame:
    """The table as it was at a moment; reads only partitions up to that day."""
    rows, end = current(spark, table), moment(at)
    kept = rows.filter((F.col(INGEST_DATE) <= end.cast("date")) & (F.col(INGEST_TIME) <= end))
    return kept.drop(*BOOKKEEPING)
