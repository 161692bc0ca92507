"""Opening an event stream at a start position."""

import time
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.sharded import FORMAT as SHARDED
from tidemark.sources.sharded import ShardedLog
from tidemark.sources.wire import PAYLOAD, WIRE_SCHEMA

LATEST = "LATEST"
TRIM_HORIZON = "TRIM_HORIZON"

FILE_FORMATS = ("text", "parquet", "orc")
KAFKA_OFFSETS = {LATEST: "latest", TRIM_HORIZON: "earliest"}
START_FILE = "_start_position"

# What one batch of files may hold, unless the options say.
FILE_LIMITS = {"maxFilesPerTrigger", "maxBytesPerTrigger"}
BATCH_BYTES = 2 * 1024**3


@dataclass(frozen=True)
class Source:
    """A stream source: Spark format, its options, and the column with the payload.

    File folders of wire records need only ``path``, and so does ``sharded_log``, which keeps
    an offset for each folder below it; any other source that yields a payload column is
    named by its format and described by options.
    """

    path: str | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    payload: str | None = None

    @property
    def payload_column(self) -> str:
        if self.payload:
            return self.payload
        return "value" if self.format in ("text", "kafka") else PAYLOAD

    @property
    def is_files(self) -> bool:
        return self.format in FILE_FORMATS


def open_stream(
    spark: SparkSession, source: Source, start: str = LATEST, checkpoint: str | None = None
) -> DataFrame:
    """The records of a source, from ``start`` on when no checkpoint exists yet.

    TRIM_HORIZON takes all the source still holds, LATEST what arrives from now
    on. After the first start the checkpoint decides where to go on.
    """
    if source.format == SHARDED:
        spark.dataSource.register(ShardedLog)
    reader = spark.readStream.format(source.format).options(**source.options)
    reader = reader.options(**start_options(source, start))
    reader = reader.options(**batch_options(source))
    if not source.is_files:
        return reader.load(source.path) if source.path else reader.load()
    if source.format != "text":
        reader = reader.schema(WIRE_SCHEMA)
    records = reader.load(source.path)
    if start == TRIM_HORIZON:
        return records
    since = _remember_start(spark, checkpoint)
    arrived = F.col("_metadata.file_modification_time")
    return records.filter(arrived >= F.timestamp_seconds(F.lit(since)))


def start_options(source: Source, start: str) -> dict[str, str]:
    """The reader options that make a source begin at a start position.

    Files have none, they are filtered by arrival. A source this package does
    not know is handed the position as it is.
    """
    if source.format != "kafka" and not source.is_files:
        return {"startingPosition": start}
    if start not in KAFKA_OFFSETS:
        known = ", ".join(KAFKA_OFFSETS)
        raise ValueError(f"unknown start position {start!r}; known positions: {known}")
    return {} if source.is_files else {"startingOffsets": KAFKA_OFFSETS[start]}


def batch_options(source: Source) -> dict[str, str]:
    """The reader options that bound a batch of files, alike on clusters of any size.

    A long backlog becomes many batches, each of which can be run again by
    itself. Other sources have options of their own for this.
    """
    if not source.is_files or source.options.keys() & FILE_LIMITS:
        return {}
    return {"maxBytesPerTrigger": str(BATCH_BYTES)}


def _remember_start(spark: SparkSession, checkpoint: str | None) -> int:
    """The second LATEST stands for, fixed at the first start of a checkpoint.

    A restart must compare with the first start: files that came while the job
    was down are new. Whole seconds, since object stores keep no finer times.
    """
    now = int(time.time())
    if checkpoint is None:
        return now
    path = f"{checkpoint.rstrip('/')}/{START_FILE}"
    begun = spark.range(1).select(F.lit(now).cast("bigint").alias("since")).coalesce(1)
    begun.write.mode("ignore").parquet(path)
    kept = spark.read.schema("since BIGINT").parquet(path).head()
    if kept is None:
        begun.write.mode("overwrite").parquet(path)
        return now
    return kept["since"]
