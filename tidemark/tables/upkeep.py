"""Merging the many small partitions of past days into few large files.

Every micro-batch owns a partition, so a table gathers thousands of them a day.
Days that no stream writes to any more are copied to a second table with one
partition per day. A view reads closed days there and open days from the live
table; replacing it is the one step that readers see. Afterwards the closed
partitions of the live table can be dropped. Rows that come late for a closed day
are seen from the next run of ``close_days`` on.
"""

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.decode import INGEST_DATE
from tidemark.session import settings
from tidemark.tables.event_table import (
    AT_ONCE,
    BATCH,
    LIVE_TABLE,
    STREAM,
    TableSpec,
    add_columns,
    add_table,
    batch_list,
    columns_ddl,
    current,
    partition_spec,
    put_in_place,
    quoted,
    write_attempt,
)

CLOSED_BEFORE = "tidemark.closed_before"
OWNER = (INGEST_DATE, STREAM, BATCH)

# Compressed bytes that a task sorts: some thirty times as many in memory.
TASK_BYTES = 16 * 1024**2


def full_splits() -> dict[str, str]:
    """Pack small files into splits by their size, as few as hold ``TASK_BYTES`` each.

    However many cores the cluster has, and however much is closed at a time.
    """
    return {
        "spark.sql.files.openCostInBytes": "65536",
        "spark.sql.files.minPartitionNum": "1",
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
    }


def _match_columns(spark: SparkSession, live: str, closed: str) -> list[str]:
    """Give the closed table every column of the live one; returns their order."""
    fields = [f for f in spark.table(quoted(live)).schema.fields if f.name != INGEST_DATE]
    columns = f"{columns_ddl(fields)}, `{INGEST_DATE}` DATE"
    add_table(spark, TableSpec(closed), columns, [INGEST_DATE])
    have = set(spark.table(quoted(closed)).columns)
    new = [f for f in fields if f.name not in have]
    if new:
        add_columns(spark, closed, new)
    return [c for c in spark.table(quoted(closed)).columns if c != INGEST_DATE]


def _compared(spark: SparkSession, live: str, closed: str, before: date) -> DataFrame:
    """The listed batches of the days before ``before``, and how many rows of each are closed.

    What the live table got is in its list of batches, so only the closed one is counted,
    by its narrow bookkeeping columns.
    """
    past = F.col(INGEST_DATE) < F.lit(before)
    held = current(spark, closed).filter(past).groupBy(*OWNER).agg(F.count(F.lit(1)).alias("held"))
    listed = batch_list(spark, live).filter(past)
    wanted = listed.select(
        INGEST_DATE, F.col("stream").alias(STREAM), F.col("batch_id").alias(BATCH), "stored"
    )
    return wanted.join(held, list(OWNER), "left")


def close_days(spark: SparkSession, live: str, closed: str, before: date) -> None:
    """Copy what the days before ``before`` hold and the closed table does not.

    One job writes all days that lack a batch, or hold another number of its rows after a
    replay: a task reads as many small files as make up one full split, sorted by batch, so
    that reads as of a batch skip row groups. Batches that a day holds already come from
    the closed table. Each day is then put in place in one step; a run that fails changes
    nothing, and the next one starts anew.
    """
    columns = [*_match_columns(spark, live, closed), INGEST_DATE]
    compared = _compared(spark, live, closed, before)
    wrong = compared.filter("NOT stored <=> held").select(*OWNER)
    days = [row[0] for row in wrong.select(INGEST_DATE).distinct().collect()]
    if days:
        of_days = F.col(INGEST_DATE).isin(days)
        new = current(spark, live).filter(of_days).join(F.broadcast(wrong), list(OWNER), "left_semi")
        kept = current(spark, closed).filter(of_days).join(F.broadcast(wrong), list(OWNER), "left_anti")
        rows = kept.select(*columns).union(new.select(*columns))
        with settings(spark, full_splits()):
            sorted_rows = rows.sortWithinPartitions(INGEST_DATE, STREAM, BATCH)
            folder = write_attempt(spark, TableSpec(closed), sorted_rows, INGEST_DATE)
        for day in sorted(days):
            place = f"{folder}/{INGEST_DATE}={day}"
            put_in_place(spark, closed, f"{INGEST_DATE} = DATE'{day}'", place)
    if before > (closed_before(spark, closed) or date.min):
        spark.sql(
            f"ALTER TABLE {quoted(closed)} SET TBLPROPERTIES ('{CLOSED_BEFORE}' = '{before}')"
        )


def closed_before(spark: SparkSession, closed: str) -> date | None:
    """The first day that is not closed, or None if none was closed yet."""
    shown = spark.sql(f"SHOW TBLPROPERTIES {quoted(closed)}")
    found = shown.filter(F.col("key") == CLOSED_BEFORE).head()
    return found and date.fromisoformat(found["value"])


def history_view(spark: SparkSession, live: str, closed: str, view: str) -> None:
    """Point ``view`` at closed days of one table and open days of the other."""
    first_open = closed_before(spark, closed)
    if first_open is None:
        raise ValueError(f"{closed} holds no closed day")
    names = [f.name for f in spark.table(quoted(live)).schema.fields]
    columns = ", ".join(f"`{n}`" for n in names)
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(view)} TBLPROPERTIES ('{LIVE_TABLE}' = '{live}') AS "
        f"SELECT {columns} FROM {quoted(closed)} WHERE {INGEST_DATE} < DATE'{first_open}' "
        f"UNION ALL "
        f"SELECT {columns} FROM {quoted(live)} WHERE {INGEST_DATE} >= DATE'{first_open}'"
    )


def _in_parts(rows: DataFrame) -> Iterable[list]:
    """The rows a few at a time."""
    some: list = []
    for row in rows.toLocalIterator():
        some.append(row)
        if len(some) == AT_ONCE:
            yield some
            some = []
    if some:
        yield some


def drop_closed(spark: SparkSession, live: str, closed: str) -> None:
    """Drop the live partitions whose rows the closed table holds, once no reader needs them.

    A late one that ``close_days`` has not copied yet stays. Files stay where they are, as
    those of replaced attempts do: the owner of the storage removes what no partition
    names.
    """
    first_open = closed_before(spark, closed)
    if first_open is None:
        return
    held = _compared(spark, live, closed, first_open).filter("stored = held").select(*OWNER)
    for some in _in_parts(held):
        specs = ", ".join(f"PARTITION ({partition_spec(*row)})" for row in some)
        spark.sql(f"ALTER TABLE {quoted(live)} DROP IF EXISTS {specs}")
